"""Operators for preparing training text."""

import sys

from pyspark import cloudpickle

# Tasks get the code of these modules with their functions, wherever the driver found it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
