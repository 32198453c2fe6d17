"""Build and query a retrieval index over captured web pages, on Spark.

Everything here is a DataFrame-to-DataFrame function; see README.md for the map.
"""

import sys

from pyspark import cloudpickle

# Functions shipped to executors carry their code, so nothing must be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
