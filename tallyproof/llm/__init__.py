"""Operators for preparing text corpora: scoring, deduplication, decontamination, scans and mixing."""
