"""Operators for building training corpora. Nothing outside this folder imports it.

The functions that run on executors travel by value, so a cluster needs the
installed libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
