"""Batch jobs that chain the operators over stored tables."""
