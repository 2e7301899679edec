"""Many-to-one joins that stay balanced when one key holds a large share of the rows.

The small side is broadcast only when its row count is known and under a limit. Beyond
the limit the join shuffles, and the keys that are hot on the large side are spread over
several tasks in proportion to their share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The rows broadcast by this package hold ids, a term and a few numbers. Terms and ids have
# no largest length, so their bytes are checked as well as the rows.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20

# A key is hot when it holds more than 1 / HOT_KEYS of all rows. Hence there are fewer than
# HOT_KEYS hot keys whatever the data, which bounds the broadcast of the hot-key list.
HOT_KEYS = 1_000


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fits_broadcast(rows: int | None, limit: int | None = None, text_bytes: int = 0) -> bool:
    """``text_bytes``: those of all strings in the rows, besides about 60 for the rest."""
    if rows is None or rows > (BROADCAST_ROWS if limit is None else limit):
        return False
    return text_bytes + 60 * rows <= BROADCAST_BYTES


def text_bytes(df: DataFrame) -> Column:
    """An aggregate: the bytes of all strings in ``df``."""
    strings = [F.octet_length(f.name) for f in df.schema.fields if f.dataType.typeName() == "string"]
    total = F.lit(0).cast("long")
    for size in strings:
        total = total + F.coalesce(size, F.lit(0))
    return F.coalesce(F.sum(total), F.lit(0))


def broadcast_size(df: DataFrame) -> dict[str, int]:
    """``dim_rows`` and ``dim_bytes`` of a table, for ``lookup_join``."""
    row = df.agg(F.count(F.lit(1)).alias("dim_rows"), text_bytes(df).alias("dim_bytes")).first()
    return row.asDict()


def hot_keys(counts: DataFrame, keys: list[str], count: str, tasks: int) -> DataFrame:
    """Keys holding over 1 / HOT_KEYS of the total of ``count``, with their salt number.

    ``counts`` has one row per key. A key with a third of the rows gets a third of the
    tasks.
    """
    total = counts.agg(F.sum(count).alias("total")).scalar()
    return (
        counts.where(F.col(count) * F.lit(HOT_KEYS) > total)
        .select(*keys, F.greatest(F.lit(1), F.ceil(F.col(count) * tasks / total)).alias("_salts"))
    )


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str = "inner",
    *,
    dim_rows: int | None = None,
    dim_bytes: int = 0,
    hot: DataFrame | None = None,
    spread_by: list[Column] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Join ``fact`` with the per-key rows of ``dim`` (``how``: inner or left).

    ``dim_rows`` and ``dim_bytes`` (of its strings) are proven bounds on ``dim``. ``hot``
    comes from ``hot_keys`` and ``spread_by`` names what separates the rows of one hot key.
    Without them the shuffle join relies on the splitting of skewed partitions at run time.
    """
    if fits_broadcast(dim_rows, limit, dim_bytes):
        return fact.join(F.broadcast(dim), keys, how)
    if hot is None:
        return fact.join(dim, keys, how)
    hot = F.broadcast(hot)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    # Rows with a NULL key match nothing; each goes wherever its hash sends it.
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    spread = F.xxhash64(*spread_by)
    salted_fact = fact.join(hot, keys, "left").withColumn(
        "_salt", F.when(no_key, spread).otherwise(F.pmod(spread, salts))
    )
    salted_dim = dim.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    return (
        salted_fact.drop("_salts")
        .join(salted_dim.drop("_salts"), [*keys, "_salt"], how)
        .drop("_salt")
    )
