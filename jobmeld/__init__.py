"""jobmeld: entity resolution, golden records and enrichment for job-market data on Spark."""

import sys

from pyspark import cloudpickle

# Tasks carry the package's few Python helpers with them, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
