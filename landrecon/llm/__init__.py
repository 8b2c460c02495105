"""Operators of a training-data pipeline over the documents and embeddings tables.

Functions that run in Python tasks are shipped by value, so that executors need not have this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
