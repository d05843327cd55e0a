"""opinionmill: product-review analytics written as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel to the executors by value, so a cluster can run them
# without the package being installed on its machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
