"""Paged reader, dated landing folders, stored tables."""
