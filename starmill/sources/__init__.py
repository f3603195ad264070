"""Readers for raw files, catalog tables and file listings."""
