"""leafquarry: document analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel by value, so that no executor needs this package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
