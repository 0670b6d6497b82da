"""Binds the TPC-H-like test tables to retail tables, with SQL twins."""
