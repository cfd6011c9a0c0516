"""Training-data operators. Nothing else in the package imports this one.

Functions that run in Python workers are sent by value, so that executors need
not have this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
