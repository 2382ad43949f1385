"""Operators for preparing language-model training data. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# tasks receive this subpackage's code by value, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
