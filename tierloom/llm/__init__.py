"""Operators of training-data pipelines: tokens, filters, deduplication, mixing, search and scoring."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the tasks, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
