"""Operators over grids, long tables, fact tables and ledgers."""
