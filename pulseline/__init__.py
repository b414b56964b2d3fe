"""Order and device stream analytics on PySpark."""

import sys

from pyspark import cloudpickle

# Functions that run on executors carry their code along, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
