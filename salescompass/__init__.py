"""Sales and advisor-coverage analytics as Spark DataFrame jobs.

Layout: ``sources`` (tables in, tables out), ``functions`` (column expressions),
``operators`` (DataFrame -> DataFrame), ``plans`` (tables, metrics and reports built
from operators) and ``streaming`` (Structured Streaming ingest and refresh).
"""

import sys

from pyspark import cloudpickle

# Functions that run in Arrow batches travel to the executors with the query, so the package
# need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
