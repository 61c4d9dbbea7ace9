"""pairloom: a Spark-first engine for paired-image training data."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions of this package travel to the executors by value: they need no installation there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
