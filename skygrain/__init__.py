"""Sensor and weather time series on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in executors are sent by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
