"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing else in the library imports this subpackage. Its functions run inside
Python workers, so they are pickled by value: executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
