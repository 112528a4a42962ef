"""adlytics: table-level operators for wide, sparse, imbalanced binary-target data on Spark.

Every operator takes DataFrames and column names and returns DataFrames. The heavy step of
each operator is a Spark job (aggregate, join, window, shuffle); the driver only ever holds
metadata-sized results such as bounds, lambdas, thresholds, column lists and pair lists.
"""

from adlytics.session import get_spark, checkpoint_dir, cut_lineage  # noqa: F401

__version__ = "0.1.0"
