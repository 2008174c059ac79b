"""Reading and writing the ledger tables."""
