"""Operators for large training corpora.

Functions of this package that run in Python tasks are pickled by value, so executors need no
copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
