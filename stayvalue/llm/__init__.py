"""Operators for building a text corpus: filters, deduplication, search, packing, archives.

Functions that run in Spark's Python workers travel with their code, so the executors need no copy
of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
