"""Operators for preparing training text: one module per operator, Spark end to end."""

import sys

from pyspark import cloudpickle

# functions travel to the executors by value, so these need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
