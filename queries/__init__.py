"""Queries over the test tables, one or more per operator, with their SQL where SQL can say it."""

import sys

from pyspark import cloudpickle

from queries import joins, jobs, nested, plays, stages, texts, upserts, vectors  # noqa: F401
from queries.registry import REGISTRY  # noqa: F401

cloudpickle.register_pickle_by_value(sys.modules[__name__])
