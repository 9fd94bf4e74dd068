"""Operators for preparing text corpora at scale.

Nothing else in the library imports this package. Every operator takes plain
DataFrames, and its module states what it does with NULLs, empty texts, ties,
repeated rows and empty tables. ``registry`` binds the operators to the given
tables.
"""

import sys

from pyspark import cloudpickle

# Python workers get the functions of this package with the task, so executors
# need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
