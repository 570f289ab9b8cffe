"""Operators of a training-data pipeline over documents, vectors and files.

Functions of this package that run inside tasks are sent along with the task, so
executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
