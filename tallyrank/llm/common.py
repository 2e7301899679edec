"""Small pieces that several operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Bytes of text whose results a Python worker holds at once; more if one text has more.
PIECE_BYTES = 4 << 20

# Copies of a hot key are spread over this many parts before a join on the key.
SALTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def row_hash(df: DataFrame) -> Column:
    """64 bits over all columns of a row. Maps are left out: they have no fixed order."""
    names = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.col(f"`{n}`") for n in names])


def unused_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` bears that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def salted_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread: Column,
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join (inner or left) of ``rows`` with ``lookup``, one row per key, that bears hot keys.

    Each key is first reduced to its distinct salts, those few rows meet the lookup, and
    the rows then join on key and salt. No task gets more than 1 / ``salts`` of a hot key. A row's
    ``spread`` must be the same whenever it is read.
    """
    salt = unused_name(rows, "_salt")
    salted = rows.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    pairs = salted.select(*keys, salt).distinct().join(lookup, keys, how)
    return salted.join(pairs, [*keys, salt]).drop(salt)


def map_texts(
    df: DataFrame,
    text_col: str,
    make: Callable[[], Callable[[bytes | None], tuple]],
    extra: list[T.StructField],
    keep: list[str],
) -> DataFrame:
    """The columns ``keep`` of ``df`` and, from each whole text, the columns ``extra``.

    ``make()`` is called once per task and returns the function from a text's UTF-8 bytes
    (None for null) to a value for each extra column. Batches come in bounded by bytes and
    are worked on and returned in small pieces.
    """
    fields = [T.StructField(df.schema[c].name, df.schema[c].dataType, True) for c in keep]
    schema = T.StructType([*fields, *extra])
    kept = len(keep)
    picked = [F.col(f"`{c}`") for c in keep]
    at = keep.index(text_col) if text_col in keep else kept
    if at == kept:
        picked.append(F.col(f"`{text_col}`").alias(unused_name(df, "text_in")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        one = make()
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for piece in pieces(batch, at):
                texts = (x.as_buffer().to_pybytes() if x.is_valid else None for x in piece.column(at))
                rows = [one(text) for text in texts]
                columns = [piece.column(i).cast(arrow.field(i).type) for i in range(kept)]
                for i in range(len(extra)):
                    columns.append(pa.array([r[i] for r in rows], type=arrow.field(kept + i).type))
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        pa.default_memory_pool().release_unused()  # the worker serves other tasks afterwards

    return df.select(*picked).mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, at: int, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices with about ``most`` bytes of text in column ``at``, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(False))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and its values' bounds in them."""
    kind, (_, offsets, data) = column.type, column.buffers()
    wide = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)
    ends = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]
