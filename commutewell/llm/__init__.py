"""Operators for preparing training data.

Functions that run in Python workers travel by value, so that executors need no copy of this package.
"""

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["*"]))
