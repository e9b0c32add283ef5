"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage.

Functions of this subpackage that run in tasks are shipped with the task, so executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
