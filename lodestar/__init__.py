"""lodestar: classic large-scale data mining as Spark DataFrame plans.

Every public operator takes DataFrames (plus plain Python parameters) and
returns a DataFrame.  Iterative algorithms are driver loops over cached
DataFrames whose lineage is cut with reliable checkpoints in the folder
named by ``spark.checkpoint.dir``.
"""

from lodestar.session import checkpoint_dir, get_spark, scratch_path

__all__ = ["checkpoint_dir", "get_spark", "scratch_path"]
