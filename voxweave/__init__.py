"""Speech and text corpus engine for Spark."""

import sys

from pyspark import cloudpickle

# Kernels travel inside the tasks that use them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
