"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors in full: they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
