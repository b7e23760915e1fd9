"""Operators for large training-data pipelines (one module per operator).

Nothing else in the library imports this subpackage; ``queries`` registers its
queries and their SQL. Functions that run in Python workers are pickled by
value, so executors do not need the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
