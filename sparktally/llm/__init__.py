"""Training-data operators over documents, pages, vectors and conversations.

The functions that run in tasks are pickled by value, so executors need the
libraries they use but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
