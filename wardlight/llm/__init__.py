"""Operators of a training-data pipeline over raw text, urls and vectors.

Nothing else in the library imports this package. Functions that run inside tasks are
sent to the executors by value, so a cluster needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
