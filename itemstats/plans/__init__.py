"""itemstats.plans."""
