"""CSV files read by many tasks, line feeds in cells included.

A file is read as lines, which Spark splits by byte ranges. Whether a line begins a record
depends on the quotes before it: an even number of them leaves no cell open (a doubled quote
counts twice and changes nothing). So the quotes of every byte range are summed first, and the
parity of the sums before a range is what its first line starts with. Within a range a running
sum tells the lines that begin a record. Nearly all records are one line and are parsed where
they are; only lines of longer ones are put together, with those of the range they began in.

RFC 4180 is what this relies on: quotes stand around a cell or are doubled inside such a cell.
A quote in the middle of an unquoted cell shifts the parity, so files that have it need the
one-task reader. Lines end in a line feed, with or without a carriage return; where the header
has one, those before line feeds in cells go too, as with Spark's reader. Compressed files are
one range and so are read in one task each.

Defined results: an empty line between records is no record, an empty cell is missing, a quoted
empty one is the empty text, a record with fewer cells than the header has missing ones at
its end, further cells are left out. Empty files and files of a header alone give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrank.sources.scratch import materialize

_RANGE = ["_file", "_start"]


def _record_lines(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _start, _at, _line, _begins, _ends, _number) of all lines: place, text, whether a
    record begins or ends with the line, and the number of records begun in the range so far."""
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),  # ascending within a range
        F.col("value").alias("_line"),
    )
    quotes = F.length("_line") - F.length(F.replace("_line", F.lit('"'), F.lit("")))
    lines = lines.withColumn("_quotes", quotes)
    # One row per range; the window sorts the ranges of one file.
    ranges = lines.groupBy(*_RANGE).agg(F.sum("_quotes").alias("_quotes"))
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    opened = ranges.select(*_RANGE, F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)).alias("_before"))
    opened = materialize(opened, "csv-ranges")
    inside = Window.partitionBy(*_RANGE).orderBy("_at")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = F.col("_before") + F.sum("_quotes").over(so_far)
    # A row per byte range, or per file: else all lines of a file would meet in one task.
    counted = lines.join(F.broadcast(opened), _RANGE).withColumn("_after", after)
    begins = (F.col("_after") - F.col("_quotes")) % 2 == 0
    return counted.select(
        *_RANGE,
        "_at",
        "_line",
        begins.alias("_begins"),
        (F.col("_after") % 2 == 0).alias("_ends"),
        F.count_if(begins).over(so_far).alias("_number"),
    )


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _start, _number, _record): every record with the range and number it began with."""
    lines = materialize(_record_lines(spark, path), "csv-lines")
    whole = F.col("_begins") & F.col("_ends")
    short = lines.where(whole).select(*_RANGE, "_number", F.col("_line").alias("_record"))
    # Lines before the first beginning of a range go on with the last record of an earlier one.
    last = lines.groupBy(*_RANGE).agg(F.max("_number").alias("_last"))
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.when(F.col("_last") > 0, F.struct(F.col("_start").alias("start"), F.col("_last").alias("number")))
    owners = last.select(*_RANGE, F.last(begun, ignorenulls=True).over(earlier).alias("_owner"))
    parts = lines.where(~whole)
    mine = F.struct(F.col("_start").alias("start"), F.col("_number").alias("number"))
    owned = parts.join(F.broadcast(owners), _RANGE).withColumn(
        "_owner", F.when(F.col("_number") > 0, mine).otherwise(F.col("_owner"))
    )
    pieces = F.array_sort(F.collect_list(F.struct("_start", "_at", "_line")))
    # The lines of one record, which become one row.
    long = owned.groupBy("_file", "_owner").agg(F.array_join(pieces["_line"], "\n").alias("_record"))
    return short.unionByName(long.select("_file", "_owner.*", "_record").toDF(*short.columns))


def read_records(spark: SparkSession, path: str, names: list[str], options: dict) -> DataFrame:
    """All records but the first of each file, as text columns ``names``; ``options`` are those
    of Spark's CSV parser."""
    records = _records(spark, path)
    head = F.min(F.struct("_start", "_number", F.endswith("_record", F.lit("\r")).alias("_returns")))
    heads = records.groupBy("_file").agg(head.alias("_head"))
    same = (F.col("_start") == F.col("_head._start")) & (F.col("_number") == F.col("_head._number"))
    body = records.join(F.broadcast(heads), "_file").where(~same)
    plain = F.replace("_record", F.lit("\r\n"), F.lit("\n"))
    text = F.rtrim(F.when(F.col("_head._returns"), plain).otherwise(F.col("_record")), F.lit("\r"))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    cells = F.from_csv(text, schema, {**options, "header": "false"})
    return body.where(text != "").select(cells.alias("_cells")).select("_cells.*").toDF(*names)
