"""Preparing and inspecting mixed corpora of documents and records with Spark."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# The functions that run in tasks travel with the job, so that executors need
# no copy of this package.
register_pickle_by_value(sys.modules[__name__])
