"""Operators for preparing training data: documents, pages and conversations."""

import sys

from pyspark import cloudpickle

# tasks carry the code they run, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
