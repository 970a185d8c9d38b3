"""Operators of a training-data pipeline. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
