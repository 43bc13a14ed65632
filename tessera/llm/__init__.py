"""Operators for large-scale training-data pipelines (dedup, tokens, quality, packing, archives).

Nothing else in the library imports this package. Functions that run inside Spark's Python
workers are pickled by value, so executors need numpy/pyarrow and the public libraries named
in each module but not this package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
