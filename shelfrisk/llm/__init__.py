"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so only the driver needs the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
