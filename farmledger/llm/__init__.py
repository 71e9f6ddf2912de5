"""Operators for large-scale training-data pipelines.

Nothing else in the package imports this subpackage. Functions that run inside Python workers are shipped by value, so a
cluster needs no copy of the package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
