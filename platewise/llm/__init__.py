"""Training-data operators: scoring, filtering, deduplication, packing and archives of text corpora on Spark."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Executors get these functions with the job, so the package need not be installed on them.
register_pickle_by_value(sys.modules[__name__])
