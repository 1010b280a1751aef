"""Operators that prepare text corpora for training, and their queries.

Nothing else in the package imports this subpackage. Its functions travel to the executors by value, so that these
need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
