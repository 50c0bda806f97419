"""Batch document search, ranking and evaluation written as Spark jobs."""

import sys

from pyspark import cloudpickle

# Task functions carry the package's code with them, so that executors need no
# copy of it. Broadcast values are plain arrays and lists for the same reason.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
