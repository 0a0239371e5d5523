"""Operators for training-data preparation, one module each, and the queries that apply them."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the job, so executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
