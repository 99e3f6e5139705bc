"""Operators that prepare training data for language models.

Nothing else in the library imports this package. Functions that run inside Python
tasks are shipped by value, so executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
