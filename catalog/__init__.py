"""Queries over the driver tables, each beside the SQL that must agree with it."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code, as those of the library do.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
