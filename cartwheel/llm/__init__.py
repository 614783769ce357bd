"""Operators for large-scale training-data pipelines, and their registered queries."""

import sys

from pyspark import cloudpickle

# Executors get this package's functions by value: they need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
