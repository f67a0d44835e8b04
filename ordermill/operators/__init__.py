"""DataFrame-in, DataFrame-out operators on the raw and enriched tables."""
