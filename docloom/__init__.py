"""Spark jobs that turn long documents into typed policy, coverage and exposure tables."""

import sys

from pyspark import cloudpickle

# Python helpers travel with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
