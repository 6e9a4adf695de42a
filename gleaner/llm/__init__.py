"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Functions that run on the executors are sent by value, so that the workers
need not be able to import this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
