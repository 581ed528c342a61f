"""itemstats.functions."""
