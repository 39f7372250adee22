"""Event-risk analytics for public-safety data, written as PySpark DataFrame functions."""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# functions travel to the executors by value, so these need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
