"""Operators that prepare training text: filters, deduplication, mixing, packing, archives."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
