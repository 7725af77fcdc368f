"""weirgate: building clean web-text corpora with Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The Arrow kernels travel with the query, so executors do not need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
