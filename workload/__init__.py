"""Queries over pages that Spark derives from the test tables, with the SQL they must agree with."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
