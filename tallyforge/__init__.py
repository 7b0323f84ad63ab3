"""tallyforge: dataset balancing and preparation as Spark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in tasks travel by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
