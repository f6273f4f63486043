"""clusterloom: clustering, projection and cluster evaluation as Spark jobs."""

import sys

from pyspark import cloudpickle

# Task-side code travels inside the pickled job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
