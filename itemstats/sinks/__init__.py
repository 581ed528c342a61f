"""itemstats.sinks."""
