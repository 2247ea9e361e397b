"""Operators for training-data pipelines over text, pages and embeddings.

Each module holds one operator and imports only Spark, numpy-level helpers
and the package's session settings. Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so the package need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
