"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel inside the job, so workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
