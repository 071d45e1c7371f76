"""gridloom: prepare large labelled arrays with PySpark.

Arrays are tables of indexed cells; chunks, shards, stores, manifests and
reports are ordinary DataFrames derived from them.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Task-side functions travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
