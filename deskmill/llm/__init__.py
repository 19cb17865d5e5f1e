"""Training-data operators: one module per operator, next to its registered query."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the tasks whole, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
