"""Readers: delimited and JSON-lines files, catalog tables, dated delta files."""
