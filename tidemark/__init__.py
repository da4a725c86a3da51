"""Document retrieval, event analytics, listing monitoring and daily briefs on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python functions travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
