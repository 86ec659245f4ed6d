"""Operators of a training-data pipeline, each on whole tables. Nothing else in the library imports this.

Its functions are shipped to the workers by value, so these need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
