"""Operators of a training-data pipeline; nothing outside this subpackage imports it.

The functions that run in Spark's Python workers are shipped by value, so executors need the
public libraries only, not a copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
