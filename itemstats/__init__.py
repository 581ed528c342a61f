"""itemstats: classical test theory, rules and clusters for exam answers on Spark.

Every operator is a function from DataFrames to a DataFrame over one long
``responses`` table (see :mod:`itemstats.schema`).  Nothing is collected to
the driver; many papers and batches are handled by one job.
"""

from itemstats.schema import BATCH_KEYS, STUDENT_KEYS  # noqa: F401

__version__ = "0.1.0"
