"""Spark-native analytics over event, feature, text and signal tables."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions run in Python workers travel with their plan, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])
