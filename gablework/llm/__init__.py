"""Operators for large text collections. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Tasks get the code of this subpackage with their work; executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
