"""Corpus operators for training data: cleaning, de-duplication, mixing, sharding, search.

The functions that run in Python workers travel by value: executors need numpy, pyarrow and
the like, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
