"""Operators for preparing training data: scans, filters, deduplication, formatting and mixing."""
