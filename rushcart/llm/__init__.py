"""Operators for preparing training text, each a function from DataFrames to DataFrames.

Nothing else in the library imports this package. Functions that run inside Spark's
Python workers travel with their code, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
