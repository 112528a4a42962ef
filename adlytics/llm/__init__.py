"""Operators of a training-data pipeline over text tables.

The Python functions of this subpackage that run inside tasks are pickled by value, so
executors need only the installed public libraries, not a copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
