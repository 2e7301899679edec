"""SimHash near duplicates through a segment-popcount embedding.

A fingerprint's 64 bits are cut into segments, and the numbers of bits set in them are its
place in a grid. Fingerprints that differ in two bits lie at Manhattan distance two at most,
so the distance in the grid is a lower bound. Two places that near share a place within one
step of both: each fingerprint enters its own place and those one step away, and one that
meets no other in any of them is alone and leaves. The rest are verified exactly: each
enters the 64-bit values at most one bit away. All that meet at one value differ by two bits
at most, whatever their number, and any two that differ by two bits meet at one; so links to
the smallest of each meeting connect exactly what all pairs would, without making the pairs.
Nothing is capped: a meeting has at most 65 members.

Exact copies share a fingerprint and count as one node. Components are contracted by
alternating large and small stars, one written table per round.

Defined results: a null or wordless text has fingerprint zero and links like any other; a
text of fewer words than a shingle is one shingle. Null identifiers lose against others; a
component of none but null identifiers has a null ``component_id``. Repeated rows are rows
of one component. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrank.llm.common import map_texts, row_hash, salted_lookup
from tallyrank.llm.exact_dedup import merge_tree, pick_rows
from tallyrank.sources.scratch import gathered, materialize

SHINGLE = 3
SEGMENT_BITS = 2
MAX_DISTANCE = 2  # bits; the grid steps and the one-bit values are made for it
SEED = 42
_AT_ONCE = 1 << 15  # shingles whose bits are unpacked together


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Fingerprint as an unsigned integer."""
    words = (text or b"").lower().split()  # bytes: A to Z, and the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    ends = ends[min(shingle, len(words)) - 1 :]
    votes = np.zeros(64, dtype=np.int64)
    of = xxhash.xxh64_intdigest
    for i in range(0, n, _AT_ONCE):
        spans = zip(starts[i : min(n, i + _AT_ONCE)].tolist(), ends[i : i + _AT_ONCE].tolist())
        hashes = np.array([of(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(docs: DataFrame, text_col: str, id_col: str, shingle: int) -> DataFrame:
    """One narrow row per row: id, row hash, digest of the text, row_id, fp (signed)."""

    def make():
        def one(text):
            fp = simhash(text, shingle)
            return (fp - (1 << 64) if fp >> 63 else fp,)

        return one

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    narrow = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        row_hash(docs).alias("row"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.col(f"`{text_col}`").alias("text"),
    )
    prints = map_texts(
        narrow, "text", make, [T.StructField("fp", T.LongType())], ["id", "row", "digest"]
    )
    return materialize(prints.withColumn("row_id", F.monotonically_increasing_id()), "prints")


def _place(bits: int) -> Column:
    """The numbers of bits set in the segments of ``fp``, packed into one integer."""
    width = bits.bit_length()  # of a packed number: 0 to `bits`
    return F.expr(
        f"aggregate(sequence(0, {64 // bits - 1}), 0L, (place, i) -> place | shiftleft("
        f"cast(bit_count(shiftright(fp, i * {bits}) & {(1 << bits) - 1}L) as bigint), i * {width}))"
    )


def _within_a_step(bits: int) -> Column:
    """``place`` and all places one step away, as an array with nulls beyond the edges."""
    width = bits.bit_length()
    count = f"(shiftright(place, i * {width}) & {(1 << width) - 1}L)"
    # Exclusive or puts the new number in place of the old one.
    up = f"if({count} < {bits}, place ^ shiftleft({count} ^ ({count} + 1L), i * {width}), null)"
    down = f"if({count} > 0, place ^ shiftleft({count} ^ ({count} - 1L), i * {width}), null)"
    steps = f"flatten(transform(sequence(0, {64 // bits - 1}), i -> array({up}, {down})))"
    return F.expr(f"concat(array(place), {steps})")


def _not_alone(nodes: DataFrame, bits: int) -> DataFrame:
    """Fingerprints with another one at Manhattan distance two or less in the grid."""
    placed = nodes.select("fp", _place(bits).alias("place"))
    places = placed.select("fp", F.explode(_within_a_step(bits)).alias("place"))
    # A window streams through a place, however many fingerprints it holds.
    met = places.where("place is not null").withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("place"))
    )
    return met.where("n > 1").select("fp").distinct()


def _links(nodes: DataFrame) -> DataFrame:
    """Verified links (fp, hub): differing in two bits at most, connecting all that do."""
    flipped = "transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))"
    near = nodes.select("fp", F.explode(F.expr(f"concat(array(fp), {flipped})")).alias("value"))
    met = near.groupBy("value").agg(  # at most 65 members by construction
        F.collect_list("fp").alias("fps"), F.min("fp").alias("hub")
    )
    return (
        met.where(F.size("fps") > 1)
        .select(F.explode("fps").alias("fp"), "hub")
        .where("fp <> hub and bit_count(fp ^ hub) <= 2")
        .distinct()
    )


def components(links: DataFrame, a: str = "fp", b: str = "hub") -> DataFrame:
    """(node, root) for every node of an undirected graph that is not its component's root.

    Alternating large and small stars; a round is two joins and one written table.
    """
    edges = materialize(gathered(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small_m = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(small_m, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = materialize(gathered(small.where("u <> v").distinct()), "stars")
        now = edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
        ).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def near_duplicates(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    shingle: int = SHINGLE,
    segment_bits: int = SEGMENT_BITS,
    max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """One row per row: id, fp, component_id, component_size, kept, row, digest.

    ``segment_bits`` (2, 4, 8 or 16) only sets how sharp the lower bound is. The links
    hold for a ``max_distance`` of two bits alone; others raise an error.
    """
    if max_distance != MAX_DISTANCE:
        raise ValueError(f"near-duplicates are found at {MAX_DISTANCE} bits, not {max_distance}")
    prints = _fingerprints(docs, text_col, id_col, shingle)
    # A node is 8 bytes that become fifty rows: dealt to all tasks, not by size.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = prints.select("fp").distinct().repartition(tasks)
    roots = components(_links(_not_alone(nodes, segment_bits)))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )
    rows = materialize(gathered(salted_lookup(prints, rooted, ["fp"], F.col("row_id"))), "rooted")
    best = F.struct(F.col("id").isNull().alias("no_id"), "id", "row", "row_id")
    return merge_tree(rows, ["root"], best).select(
        "id",
        "fp",
        F.col("best.id").alias("component_id"),
        F.col("n").alias("component_size"),
        (F.col("row_id") == F.col("best.row_id")).alias("kept"),
        "row",
        "digest",
    )


def drop_near_duplicates(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE
) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest identifier."""
    marked = near_duplicates(docs, text_col, id_col, shingle)
    kept = marked.where("kept").select("row", "digest", F.lit(1).cast("long").alias("kept"))
    # Rows like a kept one in every column: pick_rows drops the copies.
    alike = marked.groupBy("digest", "row").agg(F.count(F.lit(1)).alias("n"))
    kept = kept.join(alike, ["digest", "row"]).select("row", "digest", "n")
    kept = materialize(gathered(kept), "kept")
    return pick_rows(docs, kept, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
