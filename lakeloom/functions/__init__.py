"""Column expressions used by the operators."""

import sys

from pyspark import cloudpickle

# task functions travel with the task, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
