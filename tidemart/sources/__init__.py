"""Readers and writers: CSV, layer tables, ledger, published tables."""
