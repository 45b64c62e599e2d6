"""Operators for the preparation of training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
