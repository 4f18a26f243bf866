"""Operators and a pipeline for preparing training text at scale.

Tasks carry this package's code themselves, so executors only need the
libraries it uses.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
