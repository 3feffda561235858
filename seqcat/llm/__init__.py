"""Operators for preparing training text.  Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# functions for Python workers travel by value, so workers need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
