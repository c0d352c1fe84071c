"""Batch loads that keep an analytics table in step with paged remote datasets."""
