"""Operators for preparing language-model training data.

Functions that run in Python workers travel whole, so the workers need not have this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
