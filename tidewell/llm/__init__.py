"""Operators for preparing text corpora: DataFrame in, DataFrame out."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
