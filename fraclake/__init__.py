"""FracMinHash set analytics expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run inside tasks travel with the job, so executors need neither an
# installed copy of this package nor a shipped archive of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
