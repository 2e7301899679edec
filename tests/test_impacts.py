"""Top-k by block bounds: the same lists as the plain join, from one scan, scoring less."""

from __future__ import annotations

import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from tallyrank.functions import weights
from tallyrank.operators import impacts
from tallyrank.operators.index import CorpusIndex
from tallyrank.operators.rankers import (
    BM25Ranker,
    TfidfRanker,
    rank_variants,
    scored_pairs,
)
from tallyrank.plans import registry


def _words(rng, n, vocabulary):
    return " ".join(f"w{min(int(rng.paretovariate(0.6)), vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module", params=["long", "string"])
def corpus(request, spark):
    rng = random.Random(7)
    texts = [_words(rng, rng.randrange(1, 60), 400) for _ in range(1_500)]
    texts += ["", "  ", None, "w1"] + ["w1 w2 w2 w3"] * 40  # ties
    rows = [(i if request.param == "long" else f"d{i}", t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, f"doc_id {request.param}, text string").repartition(4)
    queries = [(f"q{i}", _words(rng, rng.randrange(1, 30), 400)) for i in range(60)]
    queries += [("none", "unheard"), ("empty", ""), ("null", None), ("twice", "w1 w1 w1 w9 w9 w2")]
    asked = spark.createDataFrame(queries, "query_id string, query string")
    index = CorpusIndex.fit(docs, n_buckets=3)
    return index, asked


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


RANKERS = {
    "bm25": lambda i: BM25Ranker(i),
    "bm25 flat": lambda i: BM25Ranker(i, k=0.0, b=0.0, delta=0.0),
    "tf-idf": lambda i: TfidfRanker(i),
    "standard": lambda i: TfidfRanker(i, "log_scaled", "standard", count_repeats=True),
    "boolean": lambda i: TfidfRanker(i, "boolean", "standard"),
    "summation": lambda i: TfidfRanker(i, "summation", "smoothed"),
}


@pytest.mark.parametrize("name", sorted(RANKERS))
def test_equals_the_join(corpus, monkeypatch, name):
    index, asked = corpus
    if index.id_type == "string" and name not in ("bm25", "boolean"):
        pytest.skip("ids only matter for ties")
    ranker = RANKERS[name](index)
    options = [dict(top_n=5), dict(top_n=40, ties="asc", pad_zero=True)]
    if name == "standard":
        options.append(dict(top_n=2_000))
    got = [_rows(ranker.rank(asked, **o)) for o in options]
    monkeypatch.setattr(index, "impacts", None)
    assert got == [_rows(ranker.rank(asked, **o)) for o in options]


def test_variants_one_query_and_parts(corpus, monkeypatch):
    index, asked = corpus
    variants = {"a": BM25Ranker(index), "b": TfidfRanker(index, "log_scaled")}

    def results():
        return [
            _rows(rank_variants(index, variants, asked, 3)),
            _rows(BM25Ranker(index).rank("w1 w7 w7 unheard", 9)),
            _rows(BM25Ranker(index).rank("unheard", 9, pad_zero=True)),
        ]

    got = results()
    monkeypatch.setattr(index, "broadcast_limit", 150)
    assert results() == got
    monkeypatch.setattr(index, "impacts", None)
    assert results() == got


def test_weights_that_bounds_do_not_hold_for_are_joined(corpus):
    index, asked = corpus
    odd = BM25Ranker(index, delta=-3.0)
    assert odd.weight_of_arrays() is None
    plan = odd.rank(asked, 5)._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan


def test_segments_hold_every_posting_once(corpus):
    index, _ = corpus
    rows = index.impacts.where("term is not null").select("segment", "term", "places", "tfs")
    docs = index.impacts.where("term is null").select("segment", "doc_ids", "dls")
    assert docs.select("segment").distinct().count() == docs.count() <= 3
    assert docs.where("dls <> sort_array(dls)").count() == 0  # blocks begin with their shortest
    back = rows.join(docs.drop("dls"), "segment").select(
        "term", F.explode(F.arrays_zip("places", "tfs")).alias("hit"), "doc_ids"
    ).select(F.expr("doc_ids[hit.places]").alias("doc_id"), "term", F.col("hit.tfs").cast("long").alias("tf"))
    assert _rows(back) == _rows(index.postings.select("doc_id", "term", "tf"))


def test_an_index_may_leave_them_out(spark, tmp_path):
    docs = spark.createDataFrame([(1, "red shoe"), (2, "blue shoe")], "doc_id long, text string")
    path = str(tmp_path / "index")
    CorpusIndex.fit(docs, path)
    assert CorpusIndex.load(spark, path).impacts is not None
    index = CorpusIndex.fit(docs, path, ranked=False)
    assert index.impacts is None
    assert [r["doc_id"] for r in BM25Ranker(index).rank("red shoe", 5).collect()] == [1, 2]


def test_segments_may_be_added_later(spark, tmp_path):
    rng = random.Random(8)
    docs = spark.createDataFrame(
        [(i, _words(rng, rng.randrange(0, 30), 60)) for i in range(200)], "doc_id long, text string"
    )
    at_once = CorpusIndex.fit(docs, str(tmp_path / "one"), n_buckets=3)
    later = CorpusIndex.fit(docs, str(tmp_path / "two"), n_buckets=3, ranked=False)
    assert later.add_segments() is later
    assert _rows(later.impacts.drop("doc_ids", "dls")) == _rows(at_once.impacts.drop("doc_ids", "dls"))
    again = CorpusIndex.load(spark, later.path)
    assert again.impacts is not None and again.add_segments() is again
    query = _words(rng, 8, 60)
    want = sorted(map(tuple, BM25Ranker(at_once).rank(query, 7).collect()))
    assert sorted(map(tuple, BM25Ranker(again).rank(query, 7).collect())) == want


def test_only_queries_that_rank_write_segments(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(registry, "_indexes", {})
    registry.queries()["idf_lookup"](spark, sf_dir)
    assert [index.impacts for index in registry._indexes.values()] == [None]
    registry.queries()["bm25_topk"](spark, sf_dir)
    assert [index.impacts is not None for index in registry._indexes.values()] == [True]


def test_twenty_thousand_queries_scan_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    index = CorpusIndex.fit(docs)
    few = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", F.col("text").alias("query"))
    many = few.select(F.explode(F.sequence(F.lit(0), F.lit(499))).alias("i"), "*").select(
        (F.col("item_id") * 1_000 + F.col("i")).alias("query_id"), "query"
    )
    assert many.count() == 20_000
    ranked = BM25Ranker(index).rank(many, 3)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("impacts") == 1 and "postings" not in plan
    assert plan.count("FileScan parquet") == 2  # the segments and the queries' lists
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    each = {r[0]: r[1] for r in ranked.groupBy("query_id").agg(F.sort_array(F.collect_list("doc_id"))).collect()}
    want = BM25Ranker(index).rank(few.select(F.col("item_id").alias("query_id"), "query"), 3)
    for r in want.groupBy("query_id").agg(F.sort_array(F.collect_list("doc_id")).alias("ids")).collect():
        assert all(each[r["query_id"] * 1_000 + i] == r["ids"] for i in (0, 250, 499))


def test_few_pairs_are_scored(spark):
    rng = random.Random(3)
    docs = [(i, _words(rng, rng.randrange(5, 400), 3_000)) for i in range(4_000)]
    index = CorpusIndex.fit(spark.createDataFrame(docs, "doc_id long, text string"), n_buckets=1)
    # Passages of documents, so that the best ones stand out as they do for a benchmark.
    queries = [(i, " ".join(t.split()[:30])) for i, t in docs[::100]]
    asked = spark.createDataFrame(queries, "query_id long, query string")
    rankers = {"bm25": BM25Ranker(index), "tf-idf": TfidfRanker(index)}
    for r in scored_pairs(index, rankers, asked).groupBy("variant").agg(
        F.sum("n_scored").alias("scored"), F.sum("n_matching").alias("matching")
    ).collect():
        assert r["scored"] < 0.5 * r["matching"]


def test_ranges():
    got = impacts._ranges(impacts.np.array([5, 0, 9]), impacts.np.array([2, 0, 3]))
    assert got.tolist() == [5, 6, 9, 10, 11]


def test_a_segment_is_taken_in_by_batches():
    rng = random.Random(3)
    docs = sorted((rng.randrange(1, 30), 100 + i) for i in range(50))
    row = {"segment": 1, "term": None, "places": None, "tfs": None, "idf_standard": None, "idf_smoothed": None}
    row |= {"idf_bm25": None, "avgdl": None, "uses": None}
    rows = [row | {"doc_ids": [d for _, d in docs], "dls": [n for n, _ in docs]}]
    for t in range(9):
        places = sorted(rng.sample(range(50), 20))
        uses = [{"query_id": q, "qtf": rng.randrange(1, 3)} for q in range(t % 3, 40, 3)]
        numbers = {"idf_standard": 1.0, "idf_smoothed": 1.5, "idf_bm25": 0.5 + t, "avgdl": 9.5}
        rows.append(row | numbers | {"term": f"t{t}", "places": places, "tfs": [rng.randrange(1, 9) for _ in places], "uses": uses, "doc_ids": None, "dls": None})
    names = ("places", "tfs", "doc_ids", "dls")
    uses = impacts.pa.list_(impacts.pa.struct([("query_id", "int64"), ("qtf", "int64")]))
    schema = impacts.pa.schema(
        [("segment", "int32"), ("term", "string")]
        + [(n, impacts.pa.list_(impacts.pa.int32() if n in names[:2] else impacts.pa.int64())) for n in names]
        + [(n, "float64") for n in ("idf_standard", "idf_smoothed", "idf_bm25", "avgdl")]
        + [("uses", uses)]
    )
    rng.shuffle(rows)
    batch = impacts.pa.RecordBatch.from_pylist(rows, schema=schema)
    weight = partial(weights.bm25_weights, 1.2, 0.75, 1.0)
    for size in (1, 4, len(rows)):
        segment = impacts.Segment(batch.slice(i, size) for i in range(0, len(rows), size))
        worth, bound = segment.weigh(weight, "idf_bm25")
        assert segment.place.itemsize == segment.tf.itemsize == segment.term.itemsize == 4
        for query, terms, qtf in impacts._each_query(segment):
            sums: dict = {}
            for r in rows:
                for use in r["uses"] or ():
                    if use["query_id"] == segment.query_ids[query].as_py():
                        for place, tf in zip(r["places"], r["tfs"]):
                            args = [impacts.np.array([float(x)]) for x in (tf, docs[place][0], r["idf_bm25"])]
                            sums[place] = sums.get(place, 0.0) + use["qtf"] * weight(*args, 9.5)[0]
            place, score, scored, matching = segment.best(terms, qtf, worth, bound, 50, "desc", True)
            assert dict(zip(place.tolist(), score.tolist())) == pytest.approx(sums)
            assert matching == len(sums)
