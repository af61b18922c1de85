"""Store-level demand forecasting as Spark jobs.

Every operator takes DataFrames and returns a DataFrame that covers all stores
in one lazy plan.  The run date is always an argument (``as_of``); nothing in
the package reads the clock.
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code: workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
