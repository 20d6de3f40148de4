"""Operators for large training corpora: extraction, quality, duplicates, mixing, filters, search, tokens.

Functions that run inside tasks are shipped by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
