"""Top-k retrieval that skips documents which cannot reach the list.

At the fit, each bucket of documents also becomes a *segment*: its documents are ordered by length,
and every term of it is one row with the documents' places and counts. A segment is read by
one task, once for all queries. Eight documents in a row are a block. The largest count of a
term in a block and the length of the block's first document, its shortest, bound what the
term can be worth there, and the sum of these bounds what a query can score. A query scores the
blocks of the highest bounds first; with k scores at hand, blocks bounded below the k-th are never
scored. Results are exact, since a block is left out only if no document of it can enter the list.

All weights of the package grow with the count and shrink with the length; a ranker whose
parameters break that (``bounded`` is false) is ranked by the plain join instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrank.sources.scratch import materialize

# Fixed by trial at sf0.1 (see README): smaller blocks have tighter bounds and more of them.
BLOCK = 8
# Blocks that are scored before the k-th score is known, and before it is asked again.
_FIRST, _SECOND = 16, 64
# Scores are compared at 24 bits, so bounds must be clearly below the k-th score.
_CLEAR = 1 - 1e-6
# Postings that are weighed at once, and rows of a result that a task holds before it sends them.
_SLICE = 1 << 18
_SENT = 20_000
_NUMBERS = ("idf_standard", "idf_smoothed", "idf_bm25", "avgdl")

# weight(tf, dl, idf, avgdl) of a term as arrays, and whether repeated query terms count.
Weight = Callable[[np.ndarray, np.ndarray, np.ndarray, float], np.ndarray]


def _segment_names(spark: SparkSession, n_buckets: int) -> DataFrame:
    """(bucket, segment): for each bucket a number that the engine's hash puts into it.

    Thus a table bucketed by segment has one segment in each bucket.
    """
    tries = spark.range(n_buckets * 40).select(F.col("id").cast("int").alias("segment"))
    bucket = F.pmod(F.hash("segment"), F.lit(n_buckets)).alias("bucket")
    names = tries.groupBy(bucket).agg(F.min("segment").alias("segment"))
    return materialize(names, "segment-names")


def impact_columns(id_type: str) -> str:
    return (
        f"segment int, term string, places array<int>, tfs array<int>, "
        f"doc_ids array<{id_type}>, dls array<bigint>"
    )


def segment_rows(postings: DataFrame, doc_stats: DataFrame, n_buckets: int) -> DataFrame:
    """One row per segment and term, and one per segment (of no term) with its documents.

    ``postings(doc_id, term, tf)`` and ``doc_stats(doc_id, dl)``; a segment holds the documents
    of a bucket, whose number the index bounds.
    """
    names = _segment_names(postings.sparkSession, n_buckets)
    dealt = doc_stats.withColumn("bucket", F.pmod(F.hash("doc_id"), F.lit(n_buckets)))
    docs = dealt.join(F.broadcast(names), "bucket")
    ordered = F.sort_array(F.collect_list(F.struct("dl", "doc_id")))
    segments = materialize(docs.groupBy("segment").agg(ordered.alias("docs")), "segments")
    places = segments.select("segment", F.posexplode("docs").alias("place", "doc")).select(
        "segment", "place", F.col("doc.doc_id").alias("doc_id")
    )
    hits = (
        postings.join(places, "doc_id")
        .select("segment", "term", "place", F.col("tf").cast("int").alias("tf"))
        .repartition(n_buckets, "segment")
        .groupBy("segment", "term")
        .agg(F.sort_array(F.collect_list(F.struct("place", "tf"))).alias("hits"))
    )
    return hits.select(
        "segment",
        "term",
        F.col("hits.place").alias("places"),
        F.col("hits.tf").alias("tfs"),
        F.lit(None).alias("doc_ids"),
        F.lit(None).alias("dls"),
    ).unionByName(
        segments.select(
            "segment",
            F.lit(None).cast("string").alias("term"),
            F.lit(None).alias("places"),
            F.lit(None).alias("tfs"),
            F.col("docs.doc_id").alias("doc_ids"),
            F.col("docs.dl").alias("dls"),
        )
    )


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers from each start on, ``lengths`` of them, one range after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def _flat(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The values of a list column, one list after another, and the lists' lengths."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten(), lengths.astype(np.int64)


class Segment:
    """The rows of a segment that some query asks for, as flat arrays.

    Batches are taken in one by one and let go, so that the arrays are all that is held: some
    thirty bytes for a posting.
    """

    def __init__(self, batches: Iterable[pa.RecordBatch]):
        held: dict[str, list] = {name: [] for name in ("ids", "dl", "place", "tf", "n", "query", "qtf", "uses")}
        numbers: dict[str, list] = {name: [] for name in _NUMBERS}
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns))
            ids, _ = _flat(column["doc_ids"])
            if len(ids):
                held["ids"].append(ids.take(pa.array(np.arange(len(ids)))))  # copies, as all below do
                held["dl"].append(_flat(column["dls"])[0].to_numpy(zero_copy_only=False).astype(np.float64))
            places, n = _flat(column["places"])
            held["place"].append(places.to_numpy(zero_copy_only=False).astype(np.int32))
            held["tf"].append(_flat(column["tfs"])[0].to_numpy(zero_copy_only=False).astype(np.int32))
            held["n"].append(n)
            uses, n_uses = _flat(column["uses"])
            held["query"].append(uses.field("query_id").take(pa.array(np.arange(len(uses)))))
            held["qtf"].append(uses.field("qtf").to_numpy(zero_copy_only=False).astype(np.float64))
            held["uses"].append(n_uses)
            for name, parts in numbers.items():
                parts.append(column[name].to_numpy(zero_copy_only=False).astype(np.float64))

        def whole(name: str) -> np.ndarray:
            return np.concatenate(held.pop(name))

        self.numbers = {name: np.concatenate(parts) for name, parts in numbers.items()}
        self.doc_ids = pa.concat_arrays(held["ids"])
        self.dl, self.place, self.tf, n = whole("dl"), whole("place"), whole("tf"), whole("n")
        self.term = np.repeat(np.arange(len(n), dtype=np.int32), n)
        # An entry is the run of postings of one term in one block.
        if len(self.place):
            block = self.place // BLOCK
            starts = (block[1:] != block[:-1]) | (self.term[1:] != self.term[:-1])
            self.first = np.flatnonzero(np.concatenate([[True], starts]))
            self.largest = np.maximum.reduceat(self.tf, self.first)
            self.block = block[self.first]
        else:
            self.first = np.zeros(0, dtype=np.int64)
            self.largest = self.block = np.zeros(0, dtype=np.int32)
        self.length = np.diff(np.append(self.first, len(self.place)))
        self.entries = np.searchsorted(self.first, np.concatenate([[0], np.cumsum(n)]))
        n_uses = whole("uses")
        coded = pc.dictionary_encode(pa.concat_arrays(held.pop("query")))
        query = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(query, kind="stable")
        self.query_ids = coded.dictionary
        self.use_query = query[order]
        self.use_term = np.repeat(np.arange(len(n_uses), dtype=np.int32), n_uses)[order]
        self.use_qtf = whole("qtf")[order]

    def weigh(self, weight: Weight, idf: str) -> tuple[np.ndarray, np.ndarray]:
        """What each posting is worth, and the bound of each entry."""
        worth = self.numbers[idf]
        known = self.numbers["avgdl"]
        avgdl = known[~np.isnan(known)].max(initial=0.0)
        each = np.empty(len(self.place))
        for at in range(0, len(each), _SLICE):
            part = slice(at, at + _SLICE)
            tf, dl = self.tf[part].astype(np.float64), self.dl[self.place[part]]
            each[part] = weight(tf, dl, worth[self.term[part]], avgdl)
        # A document without tokens can be the first of a block, but holds no posting.
        shortest = np.maximum(self.dl[self.block * BLOCK], 1.0)
        largest = self.largest.astype(np.float64)
        return each, weight(largest, shortest, worth[self.term[self.first]], avgdl)

    def _cut(self, place: np.ndarray, score: np.ndarray, top_n: int, ties: str) -> np.ndarray:
        """Positions of the ``top_n`` by the order of ``rank``: first 24 bits, then the id."""
        if len(score) <= top_n:
            return np.arange(len(score))
        key = score.astype(np.float32)
        least = np.partition(key, -top_n)[-top_n]
        above, even = np.flatnonzero(key > least), np.flatnonzero(key == least)
        missing = top_n - len(above)
        if len(even) > missing:
            order = "descending" if ties == "desc" else "ascending"
            ids = self.doc_ids.take(pa.array(place[even]))
            even = even[pc.sort_indices(ids, sort_keys=[("", order)]).to_numpy()[:missing]]
        return np.concatenate([above, even])

    def best(
        self,
        terms: np.ndarray,
        factor: np.ndarray,
        worth: np.ndarray,
        bound: np.ndarray,
        top_n: int,
        ties: str,
        counts: bool = False,
    ) -> tuple[np.ndarray, np.ndarray, int, int]:
        """Places and scores of a query's best documents; how many were scored, and with
        ``counts`` how many match."""
        n_docs = len(self.dl)
        n_blocks = -(-n_docs // BLOCK)
        n_entries = self.entries[terms + 1] - self.entries[terms]
        entry = _ranges(self.entries[terms], n_entries)
        times = np.repeat(factor, n_entries)
        block = self.block[entry]
        most = np.bincount(block, bound[entry] * times, n_blocks)
        waiting = np.bincount(block, minlength=n_blocks) > 0
        place, score = np.zeros(0, dtype=np.int64), np.zeros(0)
        scored, least = 0, 0.0
        for size in (_FIRST, _SECOND, n_blocks):
            blocks = np.flatnonzero(waiting & (most >= least * _CLEAR))
            if not len(blocks):
                break
            if len(blocks) > size:
                blocks = blocks[np.argpartition(most[blocks], -size)[-size:]]
            chosen = np.zeros(n_blocks, dtype=bool)
            chosen[blocks] = True
            waiting &= ~chosen
            hit = np.flatnonzero(chosen[block])
            here = entry[hit]
            posting = _ranges(self.first[here], self.length[here])
            gain = worth[posting] * np.repeat(times[hit], self.length[here])
            places = self.place[posting]
            new = np.flatnonzero(np.bincount(places, minlength=n_docs))
            scored += len(new)
            place = np.concatenate([place, new])
            score = np.concatenate([score, np.bincount(places, gain, n_docs)[new]])
            keep = self._cut(place, score, top_n, ties)
            place, score = place[keep], score[keep]
            if len(score) == top_n:
                least = max(0.0, float(score.min()))
        matching = 0
        if counts:
            matching = len(np.unique(self.place[_ranges(self.first[entry], self.length[entry])]))
        return place, score, scored, matching


def _each_query(segment: Segment):
    """(number of the query, its terms, how often it has each)."""
    bounds = np.flatnonzero(np.diff(segment.use_query, prepend=-1, append=-1))
    for a, b in zip(bounds, bounds[1:]):
        yield int(segment.use_query[a]), segment.use_term[a:b], segment.use_qtf[a:b]


def top_of_segments(
    asked: DataFrame,
    variants: dict[str, tuple[Weight, str, bool]],
    top_n: int,
    ties: str,
    query_type: T.DataType,
    id_type: str,
    counts: bool = False,
) -> DataFrame:
    """(query_id, variant, doc_id, score): the best documents of each segment.

    ``asked`` has the rows of segments that queries need: the term's statistics and ``uses``
    (query_id, qtf) beside them. A variant is a weight, the name of its IDF and whether repeated
    query terms count. ``counts`` instead gives (query_id, variant, n_scored, n_matching).
    """
    found = [("doc_id", id_type), ("score", "double")]
    if counts:
        found = [("n_scored", "bigint"), ("n_matching", "bigint")]
    schema = T.StructType(
        [T.StructField("query_id", query_type), T.StructField("variant", T.StringType())]
        + T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in found)).fields
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        segment = Segment(batches)

        def sent(name: str, queries: list, places: list, scores: list, numbers: list) -> pa.RecordBatch:
            query = np.concatenate(queries)
            columns = [segment.query_ids.take(pa.array(query)), pa.array([name] * len(query))]
            if counts:
                columns += [pa.array(c) for c in zip(*numbers)]
            else:
                columns.append(segment.doc_ids.take(pa.array(np.concatenate(places))))
                columns.append(pa.array(np.concatenate(scores)))
            return pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

        for name, (weight, idf, repeats) in variants.items():
            worth, bound = segment.weigh(weight, idf)
            held: tuple[list, ...] = ([], [], [], [])
            rows = 0
            for query, terms, qtf in _each_query(segment):
                factor = qtf if repeats else np.ones(len(qtf))
                place, score, *number = segment.best(terms, factor, worth, bound, top_n, ties, counts)
                n = 1 if counts else len(place)
                for parts, part in zip(held, (np.full(n, query), place, score, number)):
                    parts.append(part)
                rows += n
                if rows >= _SENT:
                    yield sent(name, *held)
                    held, rows = ([], [], [], []), 0
            if held[0]:
                yield sent(name, *held)
            del worth, bound
        pa.default_memory_pool().release_unused()  # the worker takes other segments afterwards

    return asked.groupBy("segment").applyInArrow(run, schema)
