"""Table exploration: counts, distinct values, duplicates, first and last rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrank.operators.skew import broadcast_size, hot_keys, lookup_join, shuffle_partitions
from tallyrank.sources.scratch import materialize


def profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, row_count, non_null_count) from one pass over ``df``."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns]
    )
    columns = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col("_rows").alias("row_count"),
                F.col(f.name).alias("non_null_count"),
            )
            for f in df.schema.fields
        ]
    )
    return counts.select(F.inline(columns))


def value_counts(df: DataFrame, columns: list[str] | str) -> DataFrame:
    """Rows per value, most frequent first; rows with a NULL are left out."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    counted = df.dropna(subset=columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), *columns)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, NULL included."""
    return df.select(column).distinct()


def n_distinct(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the number of distinct non-NULL values per column.

    Several columns are written once and counted one by one, each from a scan of that column
    alone: tasks drop repeats before the shuffle, so no row is repeated per column and a frequent
    value is sent once by a task.
    """
    if len(columns) < 2:
        return df.agg(*[F.countDistinct(c).alias(c) for c in columns])
    written = materialize(df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]), "distinct")
    counts = None
    for i in range(len(columns)):
        values = written.select(f"c{i}").where(F.col(f"c{i}").isNotNull()).distinct()
        one = values.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("at"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts.agg(*[F.sum(F.when(F.col("at") == i, F.col("n"))).alias(c) for i, c in enumerate(columns)])


def duplicated(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose ``keys`` occur more than once; NULLs in keys are equal to each other.

    Keys are counted with partial sums and the repeated ones written and joined back, so a
    key with a third of all rows is not gathered in one task. The keys are joined as one
    struct, which is never NULL itself.
    """
    keyed = df.withColumn("_key", F.struct(*keys))
    counts = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"))
    repeated = materialize(counts.where("_rows > 1"), "repeated-keys")
    tasks = shuffle_partitions(df.sparkSession)
    return lookup_join(
        keyed,
        repeated.select("_key"),
        ["_key"],
        **broadcast_size(repeated.select("_key.*")),
        hot=hot_keys(repeated, ["_key"], "_rows", tasks),
        spread_by=[F.col(c) for c in df.columns],
    ).select(*df.columns)


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Full-row counts of the rows with repeated ``keys``; rows with a NULL are left out."""
    return value_counts(duplicated(df, keys), df.columns)


def head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The last ``n`` rows by ``order``, in that order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)
