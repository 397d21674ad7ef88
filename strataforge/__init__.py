"""Spark jobs for telemetry tables and text corpora."""

import sys

from pyspark import cloudpickle

# Functions of this package go to the tasks by value: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
