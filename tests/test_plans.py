"""Shapes of the physical plans that carry the scale claims."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyrank.operators.index import CorpusIndex
from tallyrank.operators.rankers import BM25Ranker
from tallyrank.plans import registry
from tallyrank.sources import scratch


@pytest.fixture(scope="module")
def index(spark, sf_dir):
    return CorpusIndex.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@pytest.fixture(scope="module")
def bench_queries(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scores_are_summed_without_a_shuffle(index, bench_queries):
    plan = _plan(BM25Ranker(index).score(bench_queries))
    assert "Bucketed: true" in plan
    assert "Exchange hashpartitioning" not in plan


def test_rank_shuffles_the_cut_rows_only(index, bench_queries):
    plan = _plan(BM25Ranker(index).rank(bench_queries, 5))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(query_id" in plan
    assert plan.count("WindowGroupLimit") == 2


def test_batches_beyond_the_broadcast_limit_leave_postings_in_place(index, bench_queries):
    ranker = BM25Ranker(index)
    padded = _plan(ranker.rank(bench_queries, 5, pad_zero=True))
    want = ranker.rank(bench_queries, 5).collect()
    index.broadcast_limit = 200
    try:
        batched = ranker.rank(bench_queries, 5)
        plan = _plan(batched)
        got = batched.collect()
    finally:
        index.broadcast_limit = None
    for text in (padded, plan):
        assert "Cartesian" not in text and "NestedLoop" not in text
    assert plan.count("Bucketed: true") > 5
    assert "hashpartitioning(term" not in plan and "_salt" not in plan
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_single_query_filters_the_postings_scan(index):
    plan = _plan(BM25Ranker(index).score("that onesen erblest"))
    assert "In(term, [" in plan or "Or(EqualTo(term" in plan


def test_candidates_are_scored_without_a_shuffle_of_their_own(spark, sf_dir, index, bench_queries):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    candidates = docs.withColumn("query_id", F.col("doc_id") % 40)
    plan = _plan(BM25Ranker(index).score_docs(candidates, bench_queries))
    assert plan.count("Exchange hashpartitioning(query_id") == 1  # the query maps


def test_scratch_folder_is_the_one_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert scratch.scratch_root(spark) == root.rstrip("/")
    table = scratch.materialize(spark.range(3), "numbers")
    assert table.count() == 3
    assert all(scratch.scratch_root(spark) in f for f in table.inputFiles())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_every_query_reads_a_table_and_runs_python_only_to_rank(spark, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    plan = _plan(df)
    if name != "idf_curve":  # its rows are numbers up to the size of the table
        assert df.inputFiles()
    assert "EvalPython" not in plan and "MapIn" not in plan
    if "GroupsInArrow" in plan:  # block bounds are applied inside a segment's task
        assert "topk" in name
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_collection_counts_come_from_the_terms(spark, sf_dir):
    plan = _plan(registry.queries()["collection_tf"](spark, sf_dir))
    assert "/terms" in plan and "/postings" not in plan


def test_clear_deletes_the_scratch_tables_of_the_session(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "session_folder", lambda _: f"{tmp_path}/session")
    table = scratch.materialize(spark.range(3), "numbers")
    assert table.count() == 3
    scratch.clear(spark)
    assert not (tmp_path / "session").exists()
