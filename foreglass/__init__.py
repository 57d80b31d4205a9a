"""Forecast evaluation and data curation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python stages travel to the executors by value, so that workers need no copy
# of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
