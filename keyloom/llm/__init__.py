"""Operators for language-model training data; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers by value, so that workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
