"""Operations of a training-data pipeline over whole document tables."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
