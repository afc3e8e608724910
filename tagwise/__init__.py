"""tagwise: content-based recommendation and feedback analytics on Spark.

Every operator is a function ``op(df, ..., params) -> DataFrame`` built from
the DataFrame API so Catalyst plans it; Python runs on executors only in the
blocked similarity kernel (``applyInPandas``). Functions that run there are
pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

from tagwise.session import build_session, checkpoint_dir, ensure_checkpoint_dir

__all__ = ["build_session", "checkpoint_dir", "ensure_checkpoint_dir"]

register_pickle_by_value(sys.modules[__name__])
