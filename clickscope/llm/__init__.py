"""Operators for preparing training data: quality rules, deduplication, scoring, formats, mixing.

Functions that run in Python workers are shipped by value, so executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
