"""Operators for training-data pipelines; nothing outside this folder imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the tasks that call them, so executors need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
