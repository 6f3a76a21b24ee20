"""Listing consolidation, fee validation and publishing as Spark jobs."""

import sys

from pyspark import cloudpickle

# the few Python functions that run in tasks travel with the job, so executors need no copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
