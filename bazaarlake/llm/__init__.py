"""Operators of a training-data pipeline; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the tasks with their code, so that workers
# need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
