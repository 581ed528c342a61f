"""itemstats.sources."""
