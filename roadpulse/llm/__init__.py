"""Operators of a training-data pipeline, one module per operator.

Functions that run inside tasks are pickled by value, so executors need the
public packages only, not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
