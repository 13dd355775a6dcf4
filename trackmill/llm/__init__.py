"""Operators for preparing training data: ten components, their queries and their SQL.

Nothing else in the library imports this package; the driver's entry module adds its
queries when it is there.
"""

import trackmill
from pyspark import cloudpickle

# Functions of this library travel to the executors by value, so that a cluster needs
# numpy and the text libraries but no copy of the library itself.
cloudpickle.register_pickle_by_value(trackmill)
