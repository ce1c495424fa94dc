"""Operators of a training-data pipeline, each built on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions run inside Spark's tasks are sent with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
