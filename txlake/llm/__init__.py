"""Operators for large-scale training-data preparation.

Functions of this package travel to executors by value, so a cluster needs no copy of the package beyond the driver's.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
