"""Operators of a training-data pipeline. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions go to the executors by value: no copy of this package has to be there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
