"""Evidence retrieval over a labelled article corpus, as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few Python functions that run inside tasks travel with the job, so executors need
# Spark, NumPy and Arrow but no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
