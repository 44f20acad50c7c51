"""Operators for preparing training text: filters, deduplication, decontamination, mixing, extraction.

Functions of this package travel to the executors by value, so they need no copy of it there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
