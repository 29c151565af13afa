"""Listening-history enrichment as Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the task that needs them, so a
# cluster needs no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
