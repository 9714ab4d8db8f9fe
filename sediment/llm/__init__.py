"""Operators of a training-data pipeline. Nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to Python workers with their code: workers need not find the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
