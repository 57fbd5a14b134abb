"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions that run on workers travel with the query, so workers need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
