"""Implicit-feedback recommendation as composable Spark DataFrame operators and batch jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
