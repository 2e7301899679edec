"""Vector codes: each part of a vector becomes the index of its nearest codebook entry.

Vectors are turned into integers, cut into equal parts, and every part position has a codebook,
trained by Lloyd rounds in integers. A round does not meet all entries again: with each part
are kept its b closest other entries in the order of lower bounds on their distance, and
one outer bound for all entries beyond these (the adaptive bounds of Drake and Hamerly). Entries
that moved lower the bounds by as much. The distance to the present entry is computed in integers;
where it is under every bound the part stays, without meeting any other entry. Otherwise the
entries whose bounds it reaches are verified in integers, and all entries only if it reaches the
outer bound. Bounds are rounded down, so they only ever decide what needs no look. b follows what
the parts needed in the round before.

The parts with their bounds are a table that is written once a round: lost executors cost a
round's missing tasks. Sums per entry are added up in each task before the shuffle, which holds
at most one row per entry and task; codebooks (parts x entries) are what the driver holds.

Defined results: a vector that is null or holds a null or non-finite component is dropped.
Vectors shorter than the longest, or than a multiple of the number of parts, are read as if
zeros followed. The first codebooks come from the smallest identifiers, null ones last and ties
by the vector; with fewer rows than entries there are fewer entries. Repeated rows are rows of
their own. An empty table gives no rows and empty codebooks. Columns of any name may be present:
results are in one struct whose name gets underscores in front until it is free. Values so large
that a squared distance would leave 64 bits (about 200,000 at 16 components a part) are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrank.llm.common import flat_bytes, unused_name
from tallyrank.sources.scratch import materialize

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
NEAREST = 16  # b of the first round

_ROWS = 2_048  # rows that a worker holds the distances of at once
_UP = 1 + 1e-12  # covers the rounding of a square root
# Cost of keeping one bound, as a share of that of verifying one entry.
_KEEP_COST = 0.2

RESULT = T.StructType(
    [
        T.StructField("codes", T.ArrayType(T.IntegerType())),
        T.StructField("error", T.LongType()),
    ]
)
_STATE = [
    T.StructField("v", T.ArrayType(T.IntegerType())),
    T.StructField("codes", T.ArrayType(T.IntegerType())),
    T.StructField("errors", T.ArrayType(T.LongType())),
    T.StructField("used", T.ArrayType(T.IntegerType())),
    T.StructField("near", T.BinaryType()),  # parts x b entries, 16 bits
    T.StructField("low", T.BinaryType()),  # parts x b lower bounds, 32 bits
    T.StructField("outer", T.BinaryType()),  # parts lower bounds, 32 bits
]


@dataclass
class Bounds:
    """Of the rows of one part position: the present entry and what bounds the others."""

    code: np.ndarray  # (n,)
    near: np.ndarray  # (n, b)
    low: np.ndarray  # (n, b), infinite where there is no entry
    outer: np.ndarray  # (n,)

    def resized(self, b: int) -> Bounds:
        have = self.near.shape[1]
        if b < have:  # what falls out of the list is covered by the outer bound
            outer = np.minimum(self.outer, self.low[:, b:].min(axis=1))
            return Bounds(self.code, self.near[:, :b], self.low[:, :b], outer)
        extra = ((0, 0), (0, b - have))
        low = np.pad(self.low, extra, constant_values=np.inf)
        return Bounds(self.code, np.pad(self.near, extra), low, self.outer)


def _down(distance: np.ndarray) -> np.ndarray:
    """32-bit numbers that are surely not above the given ones, and not below zero."""
    lower = np.nextafter(distance.astype(np.float32), np.float32(-np.inf))
    return np.where(np.isinf(distance), np.float32(np.inf), np.maximum(lower, np.float32(0)))


def squared_to_all(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances (n, entries). 64-bit floats must be whole and far below 2**53."""
    if x.dtype == np.float64:
        product = x @ book.T
        return (x * x).sum(1)[:, None] + (book * book).sum(1)[None] - 2 * product
    return np.stack([((x - entry) ** 2).sum(1) for entry in book], axis=1)


def squared_to(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return ((x - entries) ** 2).sum(1)


def look_at_all(x: np.ndarray, book: np.ndarray, b: int) -> tuple[Bounds, np.ndarray]:
    """The nearest entries (ties: the lower index) with fresh bounds, and the squared distances."""
    squared = squared_to_all(x, book)
    code = squared.argmin(axis=1)
    rows = np.arange(len(x))
    best = squared[rows, code]
    if len(book) - 1 <= b:
        others = np.argsort(squared, axis=1, kind="stable")
        others = others[others != code[:, None]].reshape(len(x), len(book) - 1)
        outer = np.full(len(x), np.inf, dtype=np.float32)
    else:
        rest = squared.copy()
        rest[rows, code] = rest.max(initial=0) + 1
        nearest = np.argpartition(rest, b, axis=1)[:, : b + 1]  # the last is the (b + 1)th
        outer = _down(np.sqrt(rest[rows, nearest[:, b]].astype(np.float64)))
        others = nearest[:, :b]
    low = _down(np.sqrt(np.take_along_axis(squared, others, 1).astype(np.float64)))
    return Bounds(code, others, low, outer).resized(b), best


def look_again(
    x: np.ndarray, book: np.ndarray, kept: Bounds, moved: np.ndarray
) -> tuple[Bounds, np.ndarray, np.ndarray]:
    """New nearest entries after entries ``moved`` (distances), with the same b.

    Also the squared distances, and how many places of the list each row had to verify
    (b + 1: all entries).
    """
    b = kept.near.shape[1]
    code = kept.code.copy()
    near = kept.near.copy()
    low = _down(kept.low.astype(np.float64) - moved[near])
    outer = _down(kept.outer.astype(np.float64) - moved.max(initial=0))
    best = squared_to(x, book[code])
    reach = np.sqrt(best.astype(np.float64)) * _UP
    # The bound of a place and all places behind it.
    tail = np.minimum.accumulate(np.concatenate([low, outer[:, None]], axis=1)[:, ::-1], axis=1)
    used = (tail[:, ::-1] <= reach[:, None]).sum(axis=1)

    listed = np.flatnonzero((used > 0) & (used <= b))
    if len(listed):
        at, place = np.nonzero(np.arange(b)[None] < used[listed][:, None])
        entry = near[listed][at, place]
        exact = squared_to(x[listed[at]], book[entry])
        low[listed[at], place] = _down(np.sqrt(exact.astype(np.float64)))
        found = np.full((len(listed), b), np.iinfo(np.int64).max)
        found[at, place] = exact
        own, own_best = code[listed], best[listed].astype(np.int64)
        least = np.minimum(own_best, found.min(axis=1))
        index = np.where(found == least[:, None], near[listed], len(book)).min(axis=1)
        index = np.minimum(index, np.where(own_best == least, own, len(book)))
        changed = np.flatnonzero(index != own)
        rows = listed[changed]
        # The former entry takes the place of the new one.
        place = (near[rows] == index[changed][:, None]) & (found[changed] == least[changed][:, None])
        place = place.argmax(axis=1)
        near[rows, place] = own[changed]
        low[rows, place] = _down(np.sqrt(own_best[changed].astype(np.float64)))
        code[listed], best[listed] = index, least
        order = np.argsort(low[listed], axis=1, kind="stable")
        near[listed] = np.take_along_axis(near[listed], order, 1)
        low[listed] = np.take_along_axis(low[listed], order, 1)

    lost = np.flatnonzero(used > b)
    if len(lost):
        fresh, least = look_at_all(x[lost], book, b)
        code[lost], near[lost], low[lost] = fresh.code, fresh.near, fresh.low
        outer[lost], best[lost] = fresh.outer, least
    return Bounds(code, near, low, outer), best, used


def next_width(used: dict[int, int], b: int, entries: int) -> int:
    """The b that would have cost least, by how many places the parts had to verify.

    Wider lists than b were not tried: if a tenth of the parts or more met all entries at
    the present b and no narrower list is better, it doubles. Where more than half did, entries
    still move too far for any list, and b stays for the calmer rounds to come.
    """
    n = sum(used.values())
    lost = sum(c for u, c in used.items() if u > b)
    if 2 * lost > n:
        return min(b, entries - 1)

    def cost(width: int) -> float:
        verified = sum(c * (u if u <= width else entries) for u, c in used.items())
        return verified + _KEEP_COST * width * n

    best = min(range(1, b + 1), key=cost)
    if best == b and 10 * lost >= n:
        best = 2 * b
    return max(1, min(best, entries - 1))


def _integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def _valid(vector: Column) -> Column:
    def odd(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    return vector.isNotNull() & ~F.coalesce(F.exists(vector, odd), F.lit(False))


def _largest_component(wide: int) -> int:
    """The largest size of a component whose squared distances over ``wide`` stay in 62 bits."""
    return min((1 << 31) - 1, int((2.0**62 / max(1, wide)) ** 0.5 / 2))


def _assign(state: DataFrame, first: bool, books: np.ndarray, moved: np.ndarray, b: int, as_float: bool):
    """The state after one assignment; ``first``: without bounds yet."""
    kept = [f for f in state.schema.fields if f.name not in {s.name for s in _STATE}]
    schema = T.StructType([*kept, *_STATE])
    n_kept, parts, wide = len(kept), len(books), books.shape[2]
    names = [f.name for f in kept] + (["v"] if first else [s.name for s in _STATE])
    work = books.astype(np.float64 if as_float else np.int64)

    def one_batch(batch: pa.RecordBatch, arrow: pa.Schema) -> pa.RecordBatch:
        n = batch.num_rows
        flat = batch.column(n_kept).flatten().to_numpy(zero_copy_only=False)
        x = flat.reshape(n, parts, wide).astype(work.dtype)
        codes = np.empty((n, parts), dtype=np.int32)
        errors = np.empty((n, parts), dtype=np.int64)
        used = np.full((n, parts), b + 1, dtype=np.int32)
        near = np.empty((n, parts, b), dtype=np.uint16)
        low = np.empty((n, parts, b), dtype=np.float32)
        outer = np.empty((n, parts), dtype=np.float32)
        if not first:
            before = np.asarray(batch.column(n_kept + 1).flatten()).reshape(n, parts)
            place = [flat_bytes(batch.column(n_kept + i))[0] for i in (4, 5, 6)]
            near_was = place[0].view(np.uint16).reshape(n, parts, -1)
            low_was = place[1].view(np.float32).reshape(n, parts, -1)
            outer_was = place[2].view(np.float32).reshape(n, parts)
        for p in range(parts):
            if first:
                found, best = look_at_all(x[:, p], work[p], b)
            else:
                was = Bounds(
                    before[:, p].astype(np.int64),
                    near_was[:, p].astype(np.int64),
                    low_was[:, p],
                    outer_was[:, p],
                )
                found, best, used[:, p] = look_again(x[:, p], work[p], was.resized(b), moved[p])
            codes[:, p], errors[:, p] = found.code, best
            near[:, p], low[:, p], outer[:, p] = found.near, found.low, found.outer
        ends = np.arange(n + 1, dtype=np.int32) * parts
        lists = [pa.ListArray.from_arrays(ends, a.ravel()) for a in (codes, errors, used)]
        blobs = [pa.array([row.tobytes() for row in a], pa.binary()) for a in (near, low, outer)]
        columns = [*batch.columns[: n_kept + 1], *lists, *blobs]
        return pa.RecordBatch.from_arrays(
            [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                yield one_batch(batch.slice(start, _ROWS), arrow)
        pa.default_memory_pool().release_unused()

    return state.select(*names).mapInArrow(run, schema)


def _updated(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry becomes the floored mean of its parts; an entry without parts stays."""
    wide = books.shape[2]
    parts = state.select(F.posexplode("codes").alias("part", "entry"), "v")
    sums = [F.sum(F.col("v")[F.col("part") * wide + i]).alias(f"s{i}") for i in range(wide)]
    summed = parts.groupBy("part", "entry").agg(F.count(F.lit(1)).alias("n"), *sums)
    new = books.copy()
    for row in summed.collect():  # at most parts x entries
        new[row["part"], row["entry"]] = [row[f"s{i}"] // row["n"] for i in range(wide)]
    return new


def compress(
    vectors: DataFrame,
    vector_col: str = "embedding",
    id_col: str = "vec_id",
    keep: list[str] | None = None,
    name: str = "coded",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    nearest: int = NEAREST,
) -> tuple[DataFrame, np.ndarray]:
    """The columns ``keep`` (default: all) and a struct (codes, error), and the codebooks.

    Codebooks are an array (part, entry, component) of integers; a vector is its components
    times ``scale``, rounded down. ``entries`` is at most 65,536.
    """
    if not (1 <= entries <= 1 << 16 and parts >= 1 and nearest >= 1):
        raise ValueError("entries must be 1 to 65,536, parts and nearest at least 1")
    keep = vectors.columns if keep is None else keep
    result = unused_name(vectors, name)
    held = [f"c{i}" for i in range(len(keep))]  # names of ours stay free
    vector = F.col(f"`{vector_col}`")
    rows = materialize(
        vectors.where(_valid(vector)).select(
            *[F.col(f"`{c}`").alias(h) for c, h in zip(keep, held)],
            F.col(f"`{id_col}`").alias("key"),
            _integers(vector, scale).alias("v"),
        ),
        "integer-vectors",
    )
    size = rows.agg(
        F.max(F.size("v")).alias("longest"),
        F.min(F.size("v")).alias("shortest"),
        F.max(F.array_max("v")).alias("most"),
        F.min(F.array_min("v")).alias("least"),
    ).first()
    if size["longest"] is None:
        none = rows.select(*held, F.lit(None).cast(RESULT).alias(result))
        return none.toDF(*keep, result), np.zeros((parts, 0, 0), dtype=np.int64)
    wide = -(-size["longest"] // parts)
    largest = max(abs(size["most"] or 0), abs(size["least"] or 0))
    if largest > _largest_component(wide):
        raise ValueError(f"components up to {largest / scale:g} are too large for exact distances")
    padded = F.col("v")
    if size["shortest"] != wide * parts:
        zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(wide * parts) - F.size("v"))
        padded = F.concat("v", zeros)
    state = rows.withColumn("v", padded.cast("array<int>"))
    smallest = state.orderBy(F.col("key").asc_nulls_last(), "v").limit(entries).select("v")
    start = np.array([r["v"] for r in smallest.collect()], dtype=np.int64)
    books = start.reshape(len(start), parts, wide).transpose(1, 0, 2).copy()
    state = state.drop("key")
    as_float = wide * (2.0 * largest) ** 2 < 2**52
    b = max(1, min(nearest, len(start) - 1))
    moved = np.zeros(books.shape[:2])
    for turn in range(rounds + 1):
        state = materialize(_assign(state, turn == 0, books, moved, b, as_float), "codes")
        if turn == rounds:
            break
        if turn:
            counts = state.select(F.explode("used").alias("used")).groupBy("used").count()
            b = next_width({r["used"]: r["count"] for r in counts.collect()}, b, len(start))
        new = _updated(state, books)
        moved = np.sqrt(((new - books).astype(np.float64) ** 2).sum(axis=2)) * _UP
        books = new
    error = F.aggregate("errors", F.lit(0).cast("long"), lambda a, e: a + e)
    coded = state.select(
        *held, F.struct(F.col("codes").alias("codes"), error.alias("error")).alias(result)
    )
    return coded.toDF(*keep, result), books
