"""Operators of a training-data pipeline. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors inside the tasks, so that
# they need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
