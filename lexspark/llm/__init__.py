"""Operators for training-data pipelines; nothing outside this subpackage imports it.

Functions of this subpackage travel to the Python workers by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
