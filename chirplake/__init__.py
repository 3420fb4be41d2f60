"""Streaming sentiment analytics over short posts, as plain Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers with the job that uses
# them, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
