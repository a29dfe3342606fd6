"""Operators of a training-data pipeline: one module per operator, queries in ``queries``.

The functions that run inside tasks are shipped by value, so executors need
numpy, pyarrow and the tokenizer libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
