"""Whole loads, full and incremental."""
