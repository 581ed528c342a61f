"""itemstats.streaming."""
