"""Landed pages, table scans, database reads and table writes."""
