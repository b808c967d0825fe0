"""Training-data operators.  Functions of this subpackage travel to executors by value, like the library's other kernels."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
