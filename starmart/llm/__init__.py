"""Operators for preparing training corpora; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with their code, so executors need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
