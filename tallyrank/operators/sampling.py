"""A repeatable row sample of exact size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_PREFIX = 5  # hexadecimal digits: about a million hash ranges


def sample_rows(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """min(n, size) rows with the smallest hash of ``seed`` and ``keys``.

    A count per hash range (at most 16 ** 5 rows, fixed) shows which range completes the
    sample. Only rows up to that range enter the final sort, about ``n`` in total rather
    than ``n`` from every task.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    hashed = df.withColumn("_hash", F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)))
    ranges = hashed.groupBy(F.left("_hash", F.lit(_PREFIX)).alias("_range")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    running = F.sum("_rows").over(Window.orderBy("_range"))
    last = (
        ranges.withColumn("_running", running)
        .agg(
            F.coalesce(
                F.min(F.when(F.col("_running") >= n, F.col("_range"))), F.max("_range")
            ).alias("last")
        )
        .scalar()
    )
    enough = hashed.where(F.left("_hash", F.lit(_PREFIX)) <= last)
    return enough.orderBy("_hash", *keys).limit(n).drop("_hash")
