"""Feature-by-sample analytics as plain Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Functions used inside tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
