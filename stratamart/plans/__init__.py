"""Domain plans: curation, discovery, outbound, customer changes, transfers, audit."""
