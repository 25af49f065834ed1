"""Operators that prepare text, pages, vectors and conversations for training.

Nothing outside this package imports it. Functions that run in Python workers
are pickled by value, so that executors need no copy of the package.
"""

import sys

from pyspark.cloudpickle import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
