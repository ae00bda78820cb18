"""Daily anomaly analytics over panels of time series, written for Spark."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel with their code, so executors need no copy
# of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
