"""Rolling-history panel features for one-minute snapshots, on Spark.

Every operator is a ``DataFrame -> DataFrame`` function; the full feature
plan is assembled in ``chainfeatures.plans.pipeline``.
"""

import sys

from pyspark import cloudpickle

from chainfeatures.config import FeatureParams

# Functions of the library travel to the executors by value, so they need no installed copy there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["FeatureParams"]
