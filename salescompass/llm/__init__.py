"""Operators that prepare training text.  Nothing outside this folder imports it.

Functions that run in Python workers travel with the query, so executors need numpy and
pyarrow but no installation of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
