"""Ledger views over the test tables, the queries run on them and their SQL twins."""
