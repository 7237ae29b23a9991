"""Operators for preparing training data at scale; nothing else in the library imports them."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Tasks get the functions themselves, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
