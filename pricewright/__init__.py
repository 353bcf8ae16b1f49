"""Text, pricing and retrieval analytics as Spark jobs."""

import sys

from pyspark import cloudpickle

# Tasks get the functions themselves, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
