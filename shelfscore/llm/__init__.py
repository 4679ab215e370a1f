"""Operators for training-data pipelines. Nothing else in the library imports
this package; it uses the library's general helpers.

Functions of this package that run in tasks are sent along with the task, so
that the workers need not have the library installed."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
