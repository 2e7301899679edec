"""Contiguous shards of equal bytes from global prefix sums. DataFrame functions only.

The rows are put in the order of their identifier by range partitioning. Each partition
contributes one total; the prefix sums of these few totals, broadcast back, turn the running
sums inside the partitions into global ones. A row belongs to the shard in whose stretch of
``total / shards`` bytes its middle byte falls, so shards are contiguous in the order and
differ by at most one row's size from the target. No row's position needs more than its own
partition and the totals, of which there are as many as range partitions.

Defined results: a null text has no bytes (each row still has ``overhead`` bytes). Null
identifiers come first. Rows with equal identifiers, and fully identical ones, each get a
place of their own. An empty table gives an empty result. A text of any length is one row
and never split; a row larger than a stretch leaves the shards it covers empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrank.llm.common import row_hash
from tallyrank.sources.scratch import materialize


def assign_shards(
    docs: DataFrame,
    shards: int,
    text_col: str = "text",
    id_col: str = "doc_id",
    overhead: int = 16,
    partitions: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, shard, slot, first_byte.

    ``slot`` counts from 0 inside the shard; ``first_byte`` is the row's place in all bytes.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    payload = F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "UTF-8")
    sized = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(payload) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(payload).alias("text_crc32"),
        row_hash(docs).alias("row"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    order = ["id", "row", "row_id"]
    # Written, so that a partition number means the same rows in the passes below. Nothing else is:
    # many small files cost an executor more than reading the columns once more for the ranges.
    ranged = materialize(
        sized.repartitionByRange(partitions, *order).withColumn("part", F.spark_partition_id()),
        "ranges",
    )
    placed = _placed(ranged, order, shards)
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first_place"))
    return placed.join(F.broadcast(firsts), "shard").select(  # at most `shards` rows
        "id",
        "size",
        "text_crc32",
        "shard",
        (F.col("place") - F.col("first_place")).alias("slot"),
        "first_byte",
    )


def _placed(ranged: DataFrame, order: list[str], shards: int) -> DataFrame:
    everything = Window.orderBy("part")
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranged.groupBy("part")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        .select(
            "part",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("bytes")
            .over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            .alias("total"),
        )
    )
    running = Window.partitionBy("part").orderBy(*order)
    inside = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.join(F.broadcast(totals), "part")  # a row per range partition
        .withColumn(
            "first_byte", F.col("bytes_before") + F.sum("size").over(inside) - F.col("size")
        )
        .withColumn("place", F.col("rows_before") + F.row_number().over(running) - 1)
        .withColumn(
            "shard",
            # The middle of the row, in decimals: bytes times shards can pass 64 bits.
            F.expr(
                f"cast((cast(2 * first_byte + size as decimal(20, 0)) * {shards})"
                " div cast(2 * total as decimal(20, 0)) as int)"
            ),
        )
        .select("id", "size", "text_crc32", "shard", "place", "first_byte")
    )
