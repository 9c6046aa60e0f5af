"""Operators for preparing training text at scale. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
