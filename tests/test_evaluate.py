from __future__ import annotations

import random

import brute
import pytest
from pyspark.sql import functions as F

from tallyrank.operators.evaluate import (
    evaluate,
    first_queries,
    ndcg_per_query,
    predict,
    predict_models,
    union_predictions,
)
from tallyrank.operators.index import CorpusIndex
from tallyrank.operators.rankers import BM25Ranker, TfidfRanker

SCHEMA = (
    "model string, query_id long, product_id string, predicted_score double,"
    " relevance_score double"
)


def _frame(spark, groups):
    rows = [
        ("m", q, f"p{i:03d}", float(score), rel)
        for q, group in groups.items()
        for i, (score, rel) in enumerate(group)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_fixed_values(spark):
    groups = {
        1: [(3, 0.0), (2, 0.6), (1, 1.0)],
        2: [(3, 1.0), (2, None)],
        3: [(2, 0.0), (1, 0.0)],
        4: [(0, 0.1)],
    }
    got = {r["query_id"]: r["ndcg"] for r in ndcg_per_query(_frame(spark, groups)).collect()}
    assert got[1] == pytest.approx(0.6373, abs=5e-5)
    assert (got[2], got[3], got[4]) == (0.0, 0.0, 1.0)
    summary = evaluate(_frame(spark, groups)).collect()
    assert [tuple(r) for r in summary] == [("m", round((0.63733 + 1.0) / 4, 4))]


@pytest.mark.parametrize("k", [1, 3, 10])
def test_random_groups_equal_brute_force(spark, k):
    rng = random.Random(k)
    labels = [1.0, 0.6, 0.1, 0.0]
    groups = {
        q: [(rng.randrange(4), rng.choice(labels + ([None] if q % 5 == 0 else []))) for _ in
            range(rng.randrange(1, 16))]
        for q in range(30)
    }
    got = {r["query_id"]: r["ndcg"] for r in ndcg_per_query(_frame(spark, groups), k).collect()}
    for q, rows in groups.items():
        assert got[q] == pytest.approx(brute.ndcg(rows, k))
        assert 0.0 <= got[q] <= 1.0 + 1e-12


def test_perfect_ranking_scores_one(spark):
    rows = {1: [(9, 1.0), (8, 0.6), (7, 0.1), (6, 0.0)]}
    assert ndcg_per_query(_frame(spark, rows)).first()["ndcg"] == pytest.approx(1.0)


def test_rows_without_query_id_are_left_out(spark):
    df = spark.createDataFrame([("m", None, "p", 1.0, 1.0), ("m", 1, "p", 1.0, 1.0)], SCHEMA)
    assert [r["query_id"] for r in ndcg_per_query(df).collect()] == [1]


def test_summary_is_sorted_best_first(spark):
    good = _frame(spark, {1: [(2, 1.0), (1, 0.0)]})
    bad = _frame(spark, {1: [(1, 1.0), (2, 0.0)]}).withColumn("model", F.lit("a_bad"))
    got = [r["model"] for r in evaluate(union_predictions(bad, good)).collect()]
    assert got == ["m", "a_bad"]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [
        (1, "b", "ignored later text", "red shoe", 1.0, "test"),
        (1, "a", "red shoe", "blue shoe", 0.1, "test"),
        (1, "c", "red shoe", "", None, "test"),
        (2, "a", "hat", "green hat", 0.0, "test"),
        (None, "a", "hat", "green hat", 0.0, "test"),
    ]
    return spark.createDataFrame(
        rows,
        "query_id long, product_id string, clean_query string, clean_product_document string,"
        " relevance_score double, split string",
    )


def test_query_is_the_first_row_of_the_group(labelled):
    got = {r["query_id"]: r["query"] for r in first_queries(labelled, ["product_id"]).collect()}
    assert got == {1: "red shoe", 2: "hat"}


def test_predictions_keep_every_candidate(spark, labelled):
    docs = spark.createDataFrame(
        [(0, "red shoe red"), (1, "blue shoe"), (2, "green hat")], "doc_id long, text string"
    )
    index = CorpusIndex.fit(docs)
    models = {"tfidf": TfidfRanker(index), "bm25": BM25Ranker(index)}
    both = predict_models(models, labelled)
    assert both.count() == 8
    single = union_predictions(
        predict(models["tfidf"], labelled, "tfidf"), predict(models["bm25"], labelled, "bm25")
    )
    assert both.columns == single.columns
    assert both.exceptAll(single).count() == 0
    empty = both.where("product_id = 'c'").collect()
    assert [r["predicted_score"] for r in empty] == [0.0, 0.0]


def test_a_query_with_most_candidates_is_cut_before_the_shuffle(spark):
    rows = spark.range(20000).select(
        F.lit("m").alias("model"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("query_id"),
        F.col("id").cast("string").alias("product_id"),
        (F.col("id") % 97).cast("double").alias("predicted_score"),
        F.lit(1.0).alias("relevance_score"),
    )
    got = ndcg_per_query(rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4
    assert got.where("query_id = -1").first()["ndcg"] == pytest.approx(1.0)


def test_small_predictions_keep_their_order(spark):
    groups = {1: [(4e-7, 1.0), (3e-7, 0.0), (1e-7, 0.0)]}
    (row,) = ndcg_per_query(_frame(spark, groups)).collect()
    assert row["ndcg"] == pytest.approx(1.0)
