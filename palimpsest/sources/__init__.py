"""Readers and writers; every reader gives rows their order as a column."""
