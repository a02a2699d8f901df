"""Operators of a training-data pipeline over documents, pages, labels and benchmark items.

Functions that run on executors travel by value, so that executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
