"""tidemark: warehouse and event-stream analytics written for Spark."""

import sys

from pyspark import cloudpickle

# stateful processors and aggregates travel with the job: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
