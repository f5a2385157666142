"""Training-data operators for large text corpora (Spark-first).

Nothing else in the library imports this subpackage; it imports only the
session helpers of the library.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so they need no
# installed copy of the library there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
