from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tallyrank.functions import weights
from tallyrank.operators import corpus, profile
from tallyrank.operators.index import CorpusIndex, bucket_count
from tallyrank.operators.sampling import sample_rows

DOCS = [(1, "red shoe red"), (2, "blue shoe"), (3, "green hat box tall"), (4, ""), (5, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


@pytest.fixture(scope="module")
def index(docs):
    return CorpusIndex.fit(docs)


def test_postings(index):
    got = {tuple(r) for r in index.postings.select("doc_id", "term", "tf", "dl").collect()}
    assert got == {
        (1, "red", 2, 3), (1, "shoe", 1, 3), (2, "blue", 1, 2), (2, "shoe", 1, 2),
        (3, "green", 1, 4), (3, "hat", 1, 4), (3, "box", 1, 4), (3, "tall", 1, 4),
    }


def test_empty_documents_count(index):
    assert index.stats.first().asDict() == {"n_docs": 5, "total_tokens": 9, "avgdl": 1.8}
    lengths = {r["doc_id"]: r["dl"] for r in index.doc_stats.collect()}
    assert lengths == {1: 3, 2: 2, 3: 4, 4: 0, 5: 0}


def test_empty_corpus(spark):
    empty = CorpusIndex.fit(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.stats.first().asDict() == {"n_docs": 0, "total_tokens": 0, "avgdl": 0.0}
    assert empty.terms.count() == 0
    assert empty.weights().count() == 0


def test_idf_lookup_of_absent_word(spark):
    docs = spark.range(25).select(F.col("id").alias("doc_id"), F.lit("dog").alias("text"))
    words = spark.createDataFrame([("dogs",), ("dog",)], "term string")
    rows = {r["term"]: r for r in CorpusIndex.fit(docs).idf_lookup(words).collect()}
    assert rows["dogs"]["df"] == 0
    assert rows["dogs"]["idf_bm25"] == pytest.approx(math.log(52))
    assert rows["dogs"]["idf_standard"] == 0.0
    assert rows["dogs"]["idf_smoothed"] == pytest.approx(math.log10(26) + 1)
    assert rows["dog"]["df"] == 25


def test_tf_variants(spark):
    # 12 tokens: "dog" three times, "pet" once.
    df = spark.createDataFrame([("dog", 3), ("pet", 1), ("cat", 0)], "word string, tf long")
    columns = [
        F.round(weights.tf_weight(m, F.col("tf"), F.lit(12)), 4) for m in weights.TF_METHODS
    ]
    got = {r[0]: tuple(r[1:]) for r in df.select("word", *columns).collect()}
    assert got == {
        "dog": (0.25, 1.0, 3.0, 0.6021),
        "pet": (0.0833, 1.0, 1.0, 0.301),
        "cat": (0.0, 0.0, 0.0, 0.0),
    }


def test_unknown_variants_are_refused(index):
    for bad in (("cosine", "smoothed"), ("normalized", "max")):
        with pytest.raises(ValueError, match="unknown"):
            index.weights(*bad)


def test_collection_lookup_takes_words_literally(spark, index):
    words = spark.createDataFrame([("shoe",), ("shoes",)], "term string")
    got = corpus.collection_lookup(index.terms, index.stats, words).collect()
    assert {tuple(r) for r in got} == {("shoe", 2, 2 / 9), ("shoes", 0, 0.0)}


def test_idf_curve(docs):
    rows = corpus.idf_curve(docs).orderBy("df").collect()
    assert [r["df"] for r in rows] == [1, 2, 3, 4, 5]
    assert rows[-1]["idf_standard"] == 0.0
    assert rows[-1]["idf_smoothed"] == 1.0


def test_vocabulary_index(spark, index):
    got = corpus.with_dense_index(index.terms.select("term"), ["term"]).collect()
    terms = sorted(r["term"] for r in got)
    assert {r["term"]: r["term_index"] for r in got} == {t: i for i, t in enumerate(terms)}


def test_distinct_documents_keep_the_smallest_id(spark):
    rows = [(5, "a"), (2, "a"), (3, ""), (4, None), (1, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus.distinct_documents(docs, "doc_id", "text").collect()
    assert {tuple(r) for r in got} == {(2, "a"), (1, "b")}


@pytest.mark.parametrize("n", [0, 1, 7, 60, 1000])
def test_sample_is_exact_and_repeatable(spark, n):
    df = spark.range(60).withColumn("x", F.col("id") % 3)
    first = {r["id"] for r in sample_rows(df, n, ["id"]).collect()}
    again = {r["id"] for r in sample_rows(df.repartition(5), n, ["id"]).collect()}
    assert len(first) == min(n, 60)
    assert first == again


def test_sample_of_copies_keeps_its_size(spark):
    df = spark.range(500).select(F.lit("same").alias("k"))
    assert sample_rows(df, 20, ["k"]).count() == 20


def test_profile_and_counts(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, None), (2, "b")], "k int, v string"
    )
    rows = {r["column_name"]: r for r in profile.profile(df).collect()}
    assert (rows["v"]["row_count"], rows["v"]["non_null_count"]) == (4, 3)
    assert [tuple(r) for r in profile.value_counts(df, "v").collect()] == [("a", 2), ("b", 1)]
    assert profile.distinct_values(df, "v").count() == 3
    assert profile.n_distinct(df, ["k", "v"]).first().asDict() == {"k": 2, "v": 2}
    assert profile.duplicated(df, ["k"]).count() == 3
    report = profile.duplicate_report(df, ["k"]).collect()
    assert [tuple(r) for r in report] == [(1, "a", 2)]
    assert [r["k"] for r in profile.tail(df, 2, ["k"]).collect()] == [1, 2]
    assert [r["k"] for r in profile.head(df, 1, ["k"]).collect()] == [1]


def test_duplicates_with_null_keys(spark):
    rows = [(None, "a"), (None, "a"), (None, None), (None, None), (1, None), (2, "b")]
    df = spark.createDataFrame(rows, "k int, v string")
    got = profile.duplicated(df, ["k", "v"]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, rows[:4]))


def test_term_statistics(index):
    row = {r["term"]: r for r in index.terms.collect()}["red"]
    assert (row["df"], row["cf"], row["max_tf"]) == (1, 2, 2)
    assert row["max_share"] == pytest.approx(2 / 3)


@pytest.mark.parametrize("docs,tokens", [(0, 0), (10, 100), (10**11, 10**14), (10, 10**15)])
def test_bucket_numbers_are_legal(docs, tokens):
    n = bucket_count(docs, tokens, 8, 100_000)
    assert 8 <= n <= 100_000
    if docs == 10**11:
        assert n == 100_000


@pytest.mark.parametrize("times", [1, 10, 60])
def test_a_bucket_does_not_grow_with_the_corpus(times):
    docs, tokens = 51_282 * times, 15_000_000 * times
    n = bucket_count(docs, tokens, 12, 100_000)
    assert docs / n <= 5_000 and tokens / n <= 2_000_000


def test_duplicates_with_a_hot_key(spark):
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    got = profile.duplicated(hot, ["k"])
    assert got.count() == 1000
    assert got.select("k").distinct().count() == 1
