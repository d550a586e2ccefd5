"""Time-ordered event analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from tickloom.core import DAY, HOUR, MINUTE, SECOND, Series, fill_typed, from_micros, interval, micros

# Functions that run in Python workers travel with the job; executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["DAY", "HOUR", "MINUTE", "SECOND", "Series", "fill_typed", "from_micros", "interval", "micros"]
