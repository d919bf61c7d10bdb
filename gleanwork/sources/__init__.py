"""Readers and writers for record files, judgments, runs, indexes and tables."""
