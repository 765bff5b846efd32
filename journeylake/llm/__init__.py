"""Operators for training-data corpora: token counts, deduplication, classifiers, mixing, packing.

Nothing else in the library imports this subpackage. Its functions travel to the executors
by value, so a cluster needs only the public Python packages they use.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
