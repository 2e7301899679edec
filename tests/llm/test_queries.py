"""The registered queries against their SQL twins, and the pipeline against plain rules."""

from __future__ import annotations

import re
import string

import compare
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tallyrank.llm import registry, simhash, sql, toxicity

_LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def test_all_operators_and_the_pipeline_are_registered():
    names = set(contract.queries())
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))
    assert "pipeline" in names
    assert set(sql.queries()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(sql.queries()))
def test_query_equals_sql(spark, sf_dir, name):
    con = compare.duckdb_tables(sf_dir)
    assert compare.differences(registry.queries()[name](spark, sf_dir), con, sql.queries()[name]) == []


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(sql.queries())))
def test_query_covers_its_table(spark, sf_dir, name):
    key, source = ("page_id", "pages") if name.startswith("op8_") else ("doc_id", "documents")
    got = registry.queries()[name](spark, sf_dir)
    want = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(
        r[0] for r in want.select(key).collect()
    )


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(corpus_pipeline.materialize(stage(spark, docs[-1], sf_dir), "stage"))
    return docs


def test_stages_keep_the_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert set(stages[0].columns) <= set(stages[-1].columns)


def test_stage_decisions(spark, sf_dir, stages):
    ids = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in stages]
    docs = stages[0]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, ~toxicity.held_out())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    score = {i: model.score(model.raw((t or "").encode())) for i, t in texts.items()}
    assert ids[1] == {i for i, s in score.items() if s < toxicity.THRESHOLD}
    groups: dict = {}
    for i in ids[1]:
        groups.setdefault((texts[i] or "").translate(_LOW), []).append(i)
    assert ids[2] == {max(g) for g in groups.values()}
    prints = {i: simhash.simhash((texts[i] or "").encode()) for i in ids[2]}
    for i in ids[2] - ids[3]:
        assert any((prints[i] ^ prints[j]).bit_count() <= 2 for j in ids[2] if j != i)
    kept = sorted(ids[3])
    assert not any(
        (prints[a] ^ prints[b]).bit_count() <= 2 for n, a in enumerate(kept) for b in kept[:n]
    )
    found = registry.queries()["op9_decontamination"](spark, sf_dir).collect()
    clean = {r["doc_id"] for r in found if not r["contaminated"]}
    after = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    assert clean & ids[3] <= set(after)
    assert all(after[i] == texts[i] for i in clean & ids[3])
    assert ids[5] == ids[4]


def test_run_equals_its_stages(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == stages[-1].columns
    assert sorted(got.select("doc_id", "n_tokens").collect()) == sorted(
        stages[-1].select("doc_id", "n_tokens").collect()
    )


def test_stages_bear_odd_tables(spark, sf_dir):
    rows = [
        (1, None, "en", "s", 0, "a", 1), (2, "", None, None, None, "b", 2), (None, "text here", "en", "s", 9, "c", 3),
        (4, "same", "en", "s", 4, "d", 4), (4, "same", "en", "s", 4, "d", 4), (5, "w " * 50_000, "en", "s", 0, "e", 5),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, digest string, row int"
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.materialize(stage(spark, docs, sf_dir), "odd")
            if name != "bpe":
                assert out.columns == docs.columns
            docs = out
        assert docs.count() == (5 if some else 0) - (1 if some else 0)
