"""Fill-in-middle texts, cut by code points through a sparse index of multibyte characters.

Where all characters are ASCII, code points and bytes count alike. So of the texts of a batch,
read as one run of UTF-8 bytes, only the characters of two to four bytes are recorded: where
each begins and how many bytes it has beyond one. A binary search among these exceptions
turns code points into bytes and back; everything between two exceptions is arithmetic.
No text is decoded.

A text of n code points is cut after ``min(h1 % (n + 1), h2 % (n + 1))`` and after the larger of
the two; h1 to h4 are the first 8-digit groups of the SHA-256 of ``<seed>:<id>``, so that a row
is cut alike wherever and whenever it is read. Empty texts, those that hold a mark already, and
a share chosen by h3 stay plain; a share of the others, chosen by h4, has the suffix first.

Defined results: a null text is the empty text and stays plain. A null identifier hashes like
the empty string. Rows with equal identifiers are cut at the same hashes; repeated rows give
repeated results. A text is one value in one task, whatever its length, with 12 bytes of index
for each multibyte character. Columns of any name may be present: all results are in one struct
whose name gets underscores in front until it is free. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrank.llm.common import flat_bytes, pieces, text_or_empty, unused_name

SEED = 1
PLAIN_PERCENT = 10
SUFFIX_FIRST_PERCENT = 20

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_ANY_MARK = "<[PSM]>"
_P, _S, _M = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))

RESULT = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)


class CutIndex:
    """Code-point and byte positions in UTF-8 bytes, by their multibyte characters alone."""

    def __init__(self, data: np.ndarray):
        place = np.int32 if len(data) < 1 << 31 else np.int64
        self.byte_at = np.flatnonzero(data >= 0xC0).astype(place)
        first = data[self.byte_at]
        excess = np.uint8(1) + (first >= 0xE0) + (first >= 0xF0)
        self.excess_before = np.zeros(len(first) + 1, dtype=place)
        np.cumsum(excess, out=self.excess_before[1:])
        self.char_at = self.byte_at - self.excess_before[:-1]

    def to_bytes(self, chars: np.ndarray) -> np.ndarray:
        return chars + self.excess_before[np.searchsorted(self.char_at, chars, "left")]

    def to_chars(self, places: np.ndarray) -> np.ndarray:
        """``places`` are bytes at which characters begin or the data ends."""
        return places - self.excess_before[np.searchsorted(self.byte_at, places, "left")]


def cut_texts(
    texts: pa.Array, digests: pa.Array, plain_percent: int, suffix_first_percent: int
) -> dict[str, list | np.ndarray]:
    """The columns of ``RESULT`` for texts and the first digests of their rows."""
    data, ends = flat_bytes(texts)
    hashes, _ = flat_bytes(digests)
    h = hashes.reshape(len(texts), -1)[:, :16].copy().view(">u4").astype(np.int64)
    index = CutIndex(data)
    starts = index.to_chars(ends)
    n = np.diff(starts)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    marked = pc.match_substring_regex(texts, _ANY_MARK).to_numpy(False).astype(bool)
    plain = (n == 0) | marked | (h[:, 2] % 100 >= 100 - plain_percent)
    suffix_first = h[:, 3] % 100 < suffix_first_percent
    at = index.to_bytes(starts[:-1, None] + cuts)
    raw = memoryview(data)
    outputs = []
    for i in range(len(texts)):
        a, b = int(ends[i]), int(ends[i + 1])
        if plain[i]:
            outputs.append(bytes(raw[a:b]))
            continue
        p, m = int(at[i, 0]), int(at[i, 1])
        prefix, middle, suffix = raw[a:p], raw[p:m], raw[m:b]
        if suffix_first[i]:
            outputs.append(b"".join((_S, suffix, _P, prefix, _M, middle)))
        else:
            outputs.append(b"".join((_P, prefix, _S, suffix, _M, middle)))
    return {
        "n": n,
        "form": np.where(plain, "plain", np.where(suffix_first, "spm", "psm")),
        "prefix_chars": np.ma.masked_array(cuts[:, 0], plain),
        "middle_chars": np.ma.masked_array(cuts[:, 1] - cuts[:, 0], plain),
        "output": outputs,
    }


def _column(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, np.ma.MaskedArray):
        return pa.array(values.data, type=kind, mask=values.mask)
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return pa.array([v if isinstance(v, bytes) else str(v) for v in values], type=kind)
    return pa.array(values, type=kind)


def transform(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    keep: list[str] | None = None,
    name: str = "fim",
    seed: int = SEED,
    plain_percent: int = PLAIN_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """The columns ``keep`` (default: all) and a struct: n, form, prefix_chars, middle_chars, output.

    ``form`` is ``plain``, ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle).
    """
    keep = docs.columns if keep is None else keep
    name = unused_name(docs, name)
    fields = [T.StructField(docs.schema[c].name, docs.schema[c].dataType, True) for c in keep]
    schema = T.StructType([*fields, T.StructField(name, RESULT)])
    key = F.concat(
        F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    )
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        inner = arrow.field(at).type
        for batch in batches:
            for piece in pieces(batch, at):
                found = cut_texts(
                    piece.column(at), piece.column(at + 1), plain_percent, suffix_first_percent
                )
                made = [_column(found[f.name], f.type) for f in inner]
                columns = [piece.column(i).cast(arrow.field(i).type) for i in range(at)]
                columns.append(pa.StructArray.from_arrays(made, fields=list(inner)))
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        pa.default_memory_pool().release_unused()

    return docs.select(
        *[F.col(f"`{c}`") for c in keep],
        text_or_empty(f"`{text_col}`").alias("text_in"),
        F.unhex(F.sha2(key, 256)).alias("digest_in"),
    ).mapInArrow(run, schema)


def restore(output: Column, form: Column) -> Column:
    """The text, rebuilt from an output and its form alone.

    A cut text holds no mark, and no mark can arise where a text meets one, so the three
    marks of an output are the only ones in it.
    """
    part = F.split(output, _ANY_MARK)  # what is before the first mark is empty
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )
