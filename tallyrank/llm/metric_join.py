"""Near-duplicate vectors by an exact metric range join.

Vectors of one group that have a cosine of at least ``threshold`` lie within
``reach = sqrt(2 - 2 * threshold)`` of each other once they have length one. That distance is
a metric, and its triangle inequality decides what meets what:

* Each group above ``cell`` vectors gets pivots from a hashed sample, no two within reach. A
  vector is at home with its nearest pivot, in a ring of distances to it: a *unit*.
* A pair is found in the lower of its two home units. So a vector is copied to a lower unit
  if its distance to that unit's pivot is within reach of the unit's own distances, and if
  the pivot is no farther than its own by more than twice the reach (or, tighter, the plane
  between the two pivots is within reach). No other unit can hold a partner.
* Vectors within half the reach of a pivot all link to each other, without being compared:
  a dense group of near copies costs its number of rows, not its square.
* Units join independently: natives in blocks of about ``cell`` vectors, and what was copied to
  them streams by. A unit with more copies than a task should read has several tasks with
  the same natives. Tasks return link counts and a spanning forest of the links, never pairs.

Equal vectors of a group are one node with a count, added up before the shuffle. Components are
contracted by alternating stars. What the driver holds is bounded by ``PIVOT_BYTES``: pivots, a
sample some ten times as large, and a row per unit. In data without near pivots (random vectors of
many dimensions) the triangle inequality excludes little, and the work nears that of comparing
each group's blocks; results are the same.

Defined results: a vector that is null, zero, or has a null or non-finite component, or
whose group is null, links with nothing and is a component of its own. Vectors of different
lengths never link, nor do empty ones. Repeated rows link with each other like any equal vectors.
A null identifier loses against others. Of a component the row with the smallest identifier is
``kept``, one row even if several share it. An empty table gives an empty result. Columns of any
name may be present: results are in one struct whose name gets underscores in front until free.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrank.llm.common import flat_bytes, salted_lookup, unused_name
from tallyrank.llm.simhash import components
from tallyrank.sources.scratch import materialize

THRESHOLD = 0.93
CELL = 2_048  # vectors of a block, which a task holds while others stream by
PIVOT_BYTES = 4 << 20
_COPIES = 8  # blocks of copied vectors that one task reads
_OVERSAMPLE = 2  # sampled vectors for each pivot, and
_EXTRA = 8  # for each group besides
_SLACK = 1e-6  # distances are rounded: bounds are loosened by as much
_NEAR = 1e-9  # cosines this near the threshold are computed again, the same for both sides
_ROWS = 512  # streamed vectors compared at once



def reach_of(threshold: float) -> float:
    return math.sqrt(max(0.0, 2.0 - 2.0 * threshold))


def unit_length(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether rows of ``a`` and ``b`` (of length one) have the cosine, for all pairs."""
    cosine = a @ b.T
    i, j = np.nonzero(np.abs(cosine - threshold) < _NEAR)
    if len(i):  # a sum of products does not depend on which side is which
        x, y = a[i], b[j]
        cosine[i, j] = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))
    return cosine >= threshold


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ pivots.T)))


def _vectors(column: pa.Array, rows: np.ndarray, kind: str) -> np.ndarray:
    """Rows of a column of packed vectors that have the same length, as a matrix."""
    data, ends = flat_bytes(column)
    if (np.diff(ends) == ends[1] - ends[0]).all():
        return data.view(kind).reshape(len(column), -1)[rows]
    return np.stack([data[ends[i] : ends[i + 1]].view(kind) for i in rows])


# -- nodes ---------------------------------------------------------------------------


def _rows(vectors: DataFrame, vector_col: str, id_col: str, group_col: str, keep: list[str]) -> DataFrame:
    """keep (as c0, c1, ...), id, label, row_id; dim, digest and vec where the vector can link."""
    kind = vectors.schema[vector_col].dataType.simpleString()
    packed = "<f4" if kind == "array<float>" else "<f8"
    vector = F.col(f"`{vector_col}`")
    if packed == "<f8":
        vector = vector.cast("array<double>")
    narrow = vectors.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)],
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{group_col}`").alias("label"),
        vector.alias("v"),
    )
    at = len(keep) + 2
    extra = [
        T.StructField("dim", T.IntegerType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("vec", T.BinaryType()),
    ]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in narrow.schema.fields[:at]] + extra)

    def pack(column: pa.Array, labels: pa.Array) -> list[tuple]:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(False))
        x = column.flatten().to_numpy(zero_copy_only=False).astype(packed) + np.zeros(1, packed)
        odd = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
        some = np.concatenate([[0], np.cumsum(x != 0)])
        found, start = [], 0
        for end, label in zip(ends.tolist(), labels.is_valid().to_pylist()):
            if not label or odd[end] > odd[start] or some[end] == some[start]:
                found.append((None, None, None))
            else:
                raw = x[start:end].tobytes()
                found.append((end - start, hashlib.sha256(raw).digest(), raw))
            start = end
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            new = zip(*pack(batch.column(at), batch.column(at - 1))) if batch.num_rows else ((),) * 3
            made = [pa.array(c, f.type) for c, f in zip(new, list(arrow)[at:])]
            old = [c.cast(f.type) for c, f in zip(batch.columns, list(arrow)[:at])]
            yield pa.RecordBatch.from_arrays([*old, *made], schema=arrow)
        pa.default_memory_pool().release_unused()

    rows = narrow.mapInArrow(run, schema).withColumn("row_id", F.monotonically_increasing_id())
    return materialize(rows, "vectors")


def _best() -> Column:
    return F.struct(F.col("id").isNull().alias("no_id"), "id", "row_id")


def _nodes(rows: DataFrame) -> DataFrame:
    """One row per different vector of a group: node, label, dim, digest, n, best, vec."""
    same = rows.where("digest is not null").groupBy("label", "dim", "digest")
    nodes = same.agg(
        F.count(F.lit(1)).alias("n"), F.min(_best()).alias("best"), F.first("vec").alias("vec")
    )
    return materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")


# -- pivots and units ----------------------------------------------------------------


@dataclass
class Pivots:
    """Pivots of the large groups; those of group g are ``first[g]`` to ``first[g + 1]``."""

    keys: list[tuple]
    first: list[int]
    points: list[np.ndarray]  # per group


@dataclass
class Unit:
    pivot: int
    ring: int
    low: float
    high: float
    n_nodes: int
    weight: int
    hub: int


def choose_pivots(nodes: DataFrame, sizes: DataFrame, packed: str, reach: float, cell: int, most_bytes: int) -> Pivots:
    """One pivot for about ``cell`` vectors of each group with more, or as many as the bytes allow."""
    large = sizes.where(F.col("size") > cell)
    total = large.agg(F.sum("size").alias("n"), F.max("dim").alias("dim")).first()
    if total["n"] is None:
        return Pivots([], [0], [])
    most = max(1, most_bytes // (8 * total["dim"]))
    per_pivot = max(cell, -(-total["n"] // most))
    # Groups that get a pivot: no more than the pivots there can be.
    groups = large.where(F.col("size") > per_pivot)
    wanted = F.col("size") / per_pivot * _OVERSAMPLE + _EXTRA
    shared = F.broadcast(groups.select("label", "dim", "size", (wanted / F.col("size")).alias("share")))
    place = F.pmod(F.xxhash64("digest"), F.lit(1 << 30))
    sample = nodes.join(shared, ["label", "dim"]).where(place < F.col("share") * (1 << 30))
    picked: dict[tuple, list] = {}
    for r in sample.select("label", "dim", "size", "digest", "vec").collect():
        picked.setdefault((r["label"], r["dim"]), []).append((bytes(r["digest"]), bytes(r["vec"]), r["size"]))
    result = Pivots([], [0], [])
    for key, found in sorted(picked.items(), key=lambda x: (str(x[0][0]), x[0][1])):
        found.sort()
        x = unit_length(np.frombuffer(b"".join(v for _, v, _ in found), dtype=packed).reshape(len(found), -1))
        chosen: list[int] = []
        for i in range(len(x)):
            if len(chosen) < -(-found[i][2] // per_pivot) and (
                not chosen or _distances(x[i : i + 1], x[chosen]).min() > reach
            ):
                chosen.append(i)
        result.keys.append(key)
        result.points.append(x[chosen])
        result.first.append(result.first[-1] + len(chosen))
    return result


def _ring(d: np.ndarray, reach: float) -> np.ndarray:
    """0: within half the reach of the pivot, so that all there link. Then rings as wide as it."""
    inner = reach / 2 - _SLACK
    outside = 1 + np.floor((d - inner) / max(reach, 0.25)).astype(np.int64)
    return np.where(d <= inner, 0, outside)


def _by_group(df: DataFrame, extra: list[T.StructField], packed: str, make) -> DataFrame:
    """``df`` (with g and vec) and new columns, by ``make(group, vectors of length one, row numbers, batch)``."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields] + extra)
    g_at, vec_at, kept = df.columns.index("g"), df.columns.index("vec"), len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for start in range(0, batch.num_rows, 4 * _ROWS):
                piece = batch.slice(start, 4 * _ROWS)
                of = piece.column(g_at).to_numpy(zero_copy_only=False)
                new = [np.empty(len(of), dtype=object) for _ in extra]
                for g in np.unique(of):
                    rows = np.flatnonzero(of == g)
                    x = unit_length(_vectors(piece.column(vec_at), rows, packed))
                    for column, values in zip(new, make(int(g), x, rows, piece)):
                        column[rows] = values
                old = [c.cast(f.type) for c, f in zip(piece.columns, list(arrow)[:kept])]
                made = [pa.array(c.tolist(), f.type) for c, f in zip(new, list(arrow)[kept:])]
                yield pa.RecordBatch.from_arrays([*old, *made], schema=arrow)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def _at_home(nodes: DataFrame, pivots: Pivots, packed: str, reach: float) -> DataFrame:
    """Nodes of the groups with pivots, with their nearest one, the distance and the ring."""
    spark = nodes.sparkSession
    kinds = T.StructType([nodes.schema["label"], nodes.schema["dim"], T.StructField("g", T.IntegerType())])
    groups = spark.createDataFrame([(*k, g) for g, k in enumerate(pivots.keys)], kinds)
    extra = [
        T.StructField("pivot", T.LongType()),
        T.StructField("d", T.DoubleType()),
        T.StructField("ring", T.LongType()),
    ]

    def nearest(g, x, rows, piece):
        d = _distances(x, pivots.points[g])
        at = d.argmin(axis=1)
        least = d[np.arange(len(x)), at]
        return at + pivots.first[g], least, _ring(least, reach)

    placed = nodes.select("node", "label", "dim", "n", "vec").join(F.broadcast(groups), ["label", "dim"])
    return materialize(_by_group(placed, extra, packed, nearest), "homes")


def _units(homes: DataFrame) -> list[Unit]:
    """At most a few rings for each pivot."""
    found = homes.groupBy("pivot", "ring").agg(
        F.min("d").alias("low"),
        F.max("d").alias("high"),
        F.count(F.lit(1)).alias("n_nodes"),
        F.sum("n").alias("weight"),
        F.min("node").alias("hub"),
    )
    rows = sorted(found.collect(), key=lambda r: (r["pivot"], r["ring"]))
    return [Unit(**r.asDict()) for r in rows]


def _targets(homes: DataFrame, pivots: Pivots, units: list[Unit], packed: str, reach: float) -> DataFrame:
    """node, label, dim, n, vec, unit and the lower units that may hold a partner."""
    number = {(u.pivot, u.ring): i for i, u in enumerate(units)}
    pivot = np.array([u.pivot for u in units])
    low = np.array([u.low for u in units]) - reach - _SLACK
    high = np.array([u.high for u in units]) + reach + _SLACK
    spans = [np.searchsorted(pivot, pivots.first[g : g + 2]) for g in range(len(pivots.keys))]
    extra = [T.StructField("unit", T.IntegerType()), T.StructField("targets", T.ArrayType(T.IntegerType()))]
    at = {c: homes.columns.index(c) for c in ("pivot", "d", "ring")}

    def lower(g, x, rows, piece):
        home, own, ring = (piece.column(at[c]).to_numpy(zero_copy_only=False)[rows] for c in ("pivot", "d", "ring"))
        unit = np.array([number[p, r] for p, r in zip(home.tolist(), ring.tolist())])
        a, b = spans[g]
        points = pivots.points[g]
        to_pivots = _distances(x, points)
        apart = _distances(points, points)[home - pivots.first[g]]
        targets = []
        for i in range(0, len(x), _ROWS):
            part = slice(i, i + _ROWS)
            of = pivot[a:b] - pivots.first[g]
            d, gap = to_pivots[part][:, of], apart[part][:, of]
            mine = own[part, None]
            near = (d >= low[a:b]) & (d <= high[a:b]) & (d <= mine + 2 * reach + _SLACK)
            near &= d * d - mine * mine <= 2 * reach * gap + _SLACK
            near &= np.arange(a, b)[None] < unit[part, None]
            targets += [(np.flatnonzero(row) + a).tolist() for row in near]
        boxed = np.empty(len(x), dtype=object)
        boxed[:] = targets
        return unit, boxed

    placed = _by_group(homes, extra, packed, lower)
    return materialize(placed.select("node", "label", "dim", "n", "vec", "unit", "targets"), "placed")


# -- joining units -------------------------------------------------------------------


class Forest:
    """Numbers 0, 1, ... with the links that first joined them."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join_rows(self, mask: np.ndarray) -> None:
        """All numbers set in a row of ``mask`` belong together."""
        row, number = np.nonzero(mask)
        same = row[1:] == row[:-1]
        pairs = np.unique(number[:-1][same] * mask.shape[1] + number[1:][same])
        for pair in pairs.tolist():
            i, j = divmod(pair, mask.shape[1])
            a, b = self.root(i), self.root(j)
            if a != b:
                self.up[b] = a
                self.edges.append((i, j))


class Block:
    """The natives of one task's unit, to which all others of the unit stream by."""

    def __init__(self, threshold: float):
        self.threshold = threshold
        self.parts: list[tuple] = []
        self.closed = False

    def add(self, node: np.ndarray, n: np.ndarray, x: np.ndarray) -> None:
        self.parts.append((node, n, x))

    def close(self, inside: bool) -> None:
        """``inside``: the natives are compared with each other too."""
        self.closed = True
        none = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros((0, 0)))
        self.node, self.n, self.x = (np.concatenate(c) for c in zip(*(self.parts or [none])))
        self.parts = []
        self.links = np.zeros(len(self.node), dtype=np.int64)
        self.forest = Forest(len(self.node))
        for i in range(0, len(self.node) if inside else 0, _ROWS):
            hit = linked(self.x[i : i + _ROWS], self.x, self.threshold)
            own = np.arange(len(hit))
            hit[own, own + i] = True
            self.links[i : i + _ROWS] = hit @ self.n - self.n[i : i + _ROWS]
            self.forest.join_rows(hit)

    def meet(self, node: np.ndarray, n: np.ndarray, x: np.ndarray) -> list[tuple]:
        found = []
        for i in range(0, len(node) if len(self.node) else 0, _ROWS):
            hit = linked(x[i : i + _ROWS], self.x, self.threshold)
            some = np.flatnonzero(hit.any(axis=1))
            if len(some):
                hit = hit[some]
                self.links += n[i : i + _ROWS][some] @ hit
                self.forest.join_rows(hit)
                ones = self.node[hit.argmax(axis=1)]
                found += zip(node[i : i + _ROWS][some].tolist(), ones.tolist(), (hit @ self.n).tolist())
        return found

    def results(self) -> list[tuple]:
        own = np.flatnonzero(self.links)
        found = [(a, None, n) for a, n in zip(self.node[own].tolist(), self.links[own].tolist())]
        return found + [(int(self.node[i]), int(self.node[j]), 0) for i, j in self.forest.edges]


_LINKS = T.StructType(
    [
        T.StructField("a", T.LongType()),
        T.StructField("b", T.LongType()),  # null: only a count
        T.StructField("links", T.LongType()),
    ]
)
_UNIT_KEY = ["label", "dim", "unit", "sub", "salt"]


def _joined(tasks: DataFrame, packed: str, threshold: float) -> DataFrame:
    """Counts and links of all units. Rows come with their unit's natives first."""
    n_tasks = int(tasks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        tasks.select(*_UNIT_KEY, "copied", "inside", "node", "n", "vec")
        .repartition(n_tasks, *_UNIT_KEY)
        .sortWithinPartitions(*_UNIT_KEY, "copied")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(_LINKS)

        def out(found: list[tuple]) -> pa.RecordBatch:
            made = [pa.array(c, f.type) for c, f in zip(zip(*found), arrow)]
            return pa.RecordBatch.from_arrays(made, schema=arrow)

        key, block, inside = None, None, False
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, dtype=bool)
            new[0] = True
            for c in range(len(_UNIT_KEY) + 1):
                column = batch.column(c)
                new[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(False).astype(bool)
            starts = [*np.flatnonzero(new).tolist(), n]
            copied = batch.column(5).to_numpy(zero_copy_only=False)
            node, weight = batch.column(7).to_numpy(), batch.column(8).to_numpy()
            for a, b in zip(starts, starts[1:]):
                here = tuple(batch.column(c)[a].as_py() for c in range(len(_UNIT_KEY)))
                if here != key:
                    if block:
                        if not block.closed:
                            block.close(inside)
                        if found := block.results():
                            yield out(found)
                    key, block, inside = here, Block(threshold), batch.column(6)[a].as_py()
                x = unit_length(_vectors(batch.column(9).slice(a, b - a), np.arange(b - a), packed))
                if not copied[a]:
                    block.add(node[a:b], weight[a:b], x)
                    continue
                if not block.closed:
                    block.close(inside)
                if found := block.meet(node[a:b], weight[a:b], x):
                    yield out(found)
        if block:
            if not block.closed:
                block.close(inside)
            if found := block.results():
                yield out(found)
        pa.default_memory_pool().release_unused()

    return ordered.mapInArrow(run, _LINKS)


def _dealt(rows: DataFrame) -> DataFrame:
    """Tasks for rows with their own unit: subs, salts, core and what it has to meet.

    A native is in one block, in all tasks of that block; within a unit it is also copied to
    the blocks before its own. Natives that all link need not meet each other.
    """
    part = F.pmod(F.xxhash64("node"), F.col("subs")).cast("int")
    own = rows.withColumn("sub", part)
    natives = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    natives = natives.select(
        "label", "dim", "unit", "sub", "salt", F.lit(False).alias("copied"),
        ((F.col("salt") == 0) & ~F.col("core")).alias("inside"), "node", "n", "vec",
    )
    again = own.where("sub > 0 and not core").withColumn(
        "sub", F.explode(F.sequence(F.lit(0), F.col("sub") - 1))
    )
    return natives.unionByName(_copies(again))


def _copies(rows: DataFrame) -> DataFrame:
    salt = F.pmod(F.xxhash64("node", F.lit(1)), F.col("salts")).cast("int")
    return rows.select(
        "label", "dim", "unit", "sub", salt.alias("salt"), F.lit(True).alias("copied"),
        F.lit(False).alias("inside"), "node", "n", "vec",
    )


def _links_of_pivots(nodes: DataFrame, pivots: Pivots, packed: str, threshold: float, cell: int) -> DataFrame:
    spark, reach = nodes.sparkSession, reach_of(threshold)
    homes = _at_home(nodes, pivots, packed, reach)
    units = _units(homes)
    placed = _targets(homes, pivots, units, packed, reach)
    aimed = placed.select(F.explode("targets").alias("unit")).groupBy("unit").count()
    copies = {r["unit"]: r["count"] for r in aimed.collect()}  # at most one row per unit
    info = []
    for i, u in enumerate(units):
        subs, core = -(-u.n_nodes // cell), u.ring == 0
        met = copies.get(i, 0) + (0 if core else u.n_nodes * (subs - 1) // 2)
        salts = max(1, -(-met // (_COPIES * cell)))
        info.append((i, subs, salts, core, met > 0 or not core, u.weight, u.hub))
    about = F.broadcast(
        spark.createDataFrame(info, "unit int, subs int, salts int, core boolean, meets boolean, weight long, hub long")
    )
    own = placed.drop("targets").join(about, "unit")
    foreign = (
        placed.select("node", "label", "dim", "n", "vec", F.explode("targets").alias("unit"))
        .join(about, "unit")
        .withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
    )
    found = _joined(_dealt(own.where("meets")).unionByName(_copies(foreign)), packed, threshold)
    # All of a core link with each other: counted from its weight, and joined by its hub.
    core = own.where("core and weight > n").select(
        F.col("node").alias("a"),
        F.when(F.col("node") != F.col("hub"), F.col("hub")).alias("b"),
        (F.col("weight") - F.col("n")).alias("links"),
    )
    return found.unionByName(core)


def _links_of_the_rest(nodes: DataFrame, sizes: DataFrame, pivots: Pivots, packed: str, threshold: float, cell: int) -> DataFrame:
    """Groups without pivots are one unit each, in blocks if they are large."""
    spark = nodes.sparkSession
    rest = nodes.select("node", "label", "dim", "n", "vec", "digest")
    if pivots.keys:
        kinds = T.StructType([nodes.schema["label"], nodes.schema["dim"]])
        done = F.broadcast(spark.createDataFrame(pivots.keys, kinds))
        rest = rest.join(done, ["label", "dim"], "left_anti")
        sizes = sizes.join(done, ["label", "dim"], "left_anti")
    if sizes.where(F.col("size") > cell).isEmpty():
        rest = rest.withColumn("subs", F.lit(1))
    else:
        subs = sizes.select("label", "dim", F.ceil(F.col("size") / cell).cast("int").alias("subs"))
        rest = salted_lookup(rest, subs, ["label", "dim"], F.col("digest"))
    alone = rest.select(
        "*", F.lit(-1).alias("unit"), F.lit(1).alias("salts"), F.lit(False).alias("core")
    )
    return _joined(_dealt(alone), packed, threshold)


def near_duplicates(
    vectors: DataFrame,
    vector_col: str = "embedding",
    id_col: str = "vec_id",
    group_col: str = "label",
    threshold: float = THRESHOLD,
    keep: list[str] | None = None,
    name: str = "near",
    cell: int = CELL,
    pivot_bytes: int = PIVOT_BYTES,
) -> DataFrame:
    """The columns ``keep`` (default: all) and a struct: n_links, component_id, kept.

    ``n_links`` counts the other rows linked directly; ``component_id`` is the smallest
    identifier reachable by links, the row's own included.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine above 0 and at most 1")
    keep = vectors.columns if keep is None else keep
    result = unused_name(vectors, name)
    packed = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"
    rows = _rows(vectors, vector_col, id_col, group_col, keep)
    nodes = _nodes(rows)
    sizes = materialize(nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("size")), "sizes")
    pivots = choose_pivots(nodes, sizes, packed, reach_of(threshold), cell, pivot_bytes)
    links = _links_of_the_rest(nodes, sizes, pivots, packed, threshold, cell)
    if pivots.keys:
        links = links.unionByName(_links_of_pivots(nodes, pivots, packed, threshold, cell))
    links = materialize(links, "vector-links")
    roots = components(links.where("b is not null"), "a", "b")
    counts = links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    rooted = (
        nodes.select("node", "label", "dim", "digest", "n", "best")
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    rooted = materialize(rooted, "rooted")
    first = rooted.groupBy("root").agg(F.min("best").alias("first"))
    known = salted_lookup(rooted, first, ["root"], F.col("node")).select(
        "label", "dim", "digest",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "first",
    )
    known = materialize(known, "known")
    held = [f"c{i}" for i in range(len(keep))]
    own = rows.drop("vec")
    met = salted_lookup(own.where("digest is not null"), known, ["label", "dim", "digest"], F.col("row_id"))
    met = met.select(
        *held,
        F.struct(
            F.col("n_links").alias("n_links"),
            F.col("first.id").alias("component_id"),
            (F.col("first.row_id") == F.col("row_id")).alias("kept"),
        ).alias(result),
    )
    alone = own.where("digest is null").select(
        *held,
        F.struct(
            F.lit(0).cast("long").alias("n_links"),
            F.col("id").alias("component_id"),
            F.lit(True).alias("kept"),
        ).alias(result),
    )
    return met.unionByName(alone).toDF(*keep, result)


def drop_near_duplicates(vectors: DataFrame, **options) -> DataFrame:
    """``vectors`` with one row of each component: that with the smallest identifier."""
    name = unused_name(vectors, "near")
    marked = near_duplicates(vectors, name=name, **options)
    return marked.where(F.col(f"{name}.kept")).select(*[F.col(f"`{c}`") for c in vectors.columns])
