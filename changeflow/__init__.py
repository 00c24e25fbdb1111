"""Lakehouse change-flow and document-index jobs on PySpark.

Every operator is a function from DataFrames to DataFrames. Clocks and run ids
are arguments; nothing here keeps a session of its own.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel by value, so the executors need no
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
