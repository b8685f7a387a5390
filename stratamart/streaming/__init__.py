"""Incremental pickup of dated delta files."""
