"""Operators that prepare training data for language models.

Nothing else in the library imports this package. Its functions are shipped to
executors by value, so a cluster needs no copy of the package on its workers.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
