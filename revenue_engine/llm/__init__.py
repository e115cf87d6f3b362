"""Training-data operators: search, mixing, deduplication, filtering, packing.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` applies them to the driver's
tables with production parameters.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
