"""Customer analytics on Spark: load, audit, clean, describe, segment."""

import sys

from pyspark import cloudpickle

# functions that run on executors travel whole, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
