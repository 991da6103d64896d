"""Spark-first analytics over marker-gene reads, count tables and communities."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry this package's code with them, so that workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
