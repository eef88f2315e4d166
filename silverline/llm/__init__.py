"""Operators for preparing training corpora; each module is one operator."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so a worker needs no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
