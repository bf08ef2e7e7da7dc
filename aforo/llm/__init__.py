"""Operators for preparing language-model training text, one module each, and their registered queries."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions of this package travel with the tasks, so executors need no copy of it.
register_pickle_by_value(sys.modules[__name__])
