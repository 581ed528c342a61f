"""itemstats.operators."""
