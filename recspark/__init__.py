"""Typed record streams on Spark: schemas, sources, order, fields, statistics, streaming."""

import sys

from pyspark import cloudpickle

# Executors need no installed copy: what runs there travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
