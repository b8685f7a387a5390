"""DataFrame operators: skew-safe joins and windows, dedup, predicates, summaries."""
