"""Writers: files, catalog tables, partition reloads, upserts."""
