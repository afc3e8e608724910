"""Operators of a training-data pipeline (de-duplication, filters, mixing,
sharding, tokenising, chat formatting, language-model scores).

The functions that run inside tasks are pickled by value, so executors need
no copy of this package on their path.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
