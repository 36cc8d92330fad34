"""The job's operators. Functions that run in Python tasks travel by value: executors need not have this package."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
