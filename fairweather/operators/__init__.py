"""DataFrame to DataFrame steps of event enrichment."""
