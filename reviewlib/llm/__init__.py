"""Operators of a training-data pipeline over ``documents``.

Functions that run on executors are shipped by value, so executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
