from __future__ import annotations

import random

import brute
import pytest
from pyspark.sql import functions as F

from tallyrank.operators.index import CorpusIndex
from tallyrank.operators.rankers import BM25Ranker, TfidfRanker, score_variants, top_documents

WORDS = [f"w{i}" for i in range(12)]


def _random_corpus(seed: int):
    rng = random.Random(seed)
    docs = {
        i: " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 9))) for i in range(40)
    }
    docs[40] = docs[3]  # an exact copy: a tie
    queries = {
        q: " ".join(rng.choice(WORDS + ["absent"]) for _ in range(rng.randrange(0, 5)))
        for q in range(8)
    }
    return docs, queries


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    docs, queries = _random_corpus(request.param)
    doc_df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    query_df = spark.createDataFrame(list(queries.items()), "query_id long, query string")
    index = CorpusIndex.fit(doc_df)
    tokens = {i: brute.split(t) for i, t in docs.items()}
    return index, doc_df, query_df, tokens, {q: brute.split(t) for q, t in queries.items()}


def _ranked(df):
    rows = df.orderBy("query_id", "rank").collect()
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return out


def _same_ranking(got, want):
    assert [(r, d) for r, d, _ in got] == [(r, d) for r, d, _ in want]
    assert [s for *_, s in got] == pytest.approx([s for *_, s in want], abs=1.1e-4)


def test_bm25_rank_with_zeros_equals_brute_force(case):
    index, _, query_df, tokens, queries = case
    model = brute.Corpus(tokens)
    got = _ranked(BM25Ranker(index).rank(query_df, 7, pad_zero=True))
    for q, terms in queries.items():
        scores = {d: model.bm25(terms, t) for d, t in tokens.items()}
        _same_ranking(got[q], brute.top(scores, 7))


def test_tfidf_rank_with_zeros_equals_brute_force(case):
    index, _, query_df, tokens, queries = case
    model = brute.Corpus(tokens)
    for tf, idf in (("normalized", "smoothed"), ("log_scaled", "standard"), ("boolean", "smoothed")):
        ranker = TfidfRanker(index, tf, idf)
        got = _ranked(ranker.rank(query_df, 6, pad_zero=True))
        for q, terms in queries.items():
            scores = {d: model.tfidf(terms, t, tf, idf) for d, t in tokens.items()}
            _same_ranking(got[q], brute.top(scores, 6))


def test_rank_without_zeros_keeps_matches_only(case):
    index, _, query_df, tokens, queries = case
    model = brute.Corpus(tokens)
    got = _ranked(BM25Ranker(index).rank(query_df, 5, positive_only=True))
    for q, terms in queries.items():
        scores = {d: s for d, t in tokens.items() if (s := model.bm25(terms, t)) > 0}
        _same_ranking(got.get(q, []), brute.top(scores, 5))


def test_ascending_ties_and_repeats(case):
    index, _, query_df, tokens, queries = case
    model = brute.Corpus(tokens)
    ranker = TfidfRanker(index, count_repeats=True)
    got = _ranked(ranker.rank(query_df, 4, pad_zero=True, ties="asc"))
    for q, terms in queries.items():
        scores = {d: model.tfidf(terms, t, repeats=True) for d, t in tokens.items()}
        _same_ranking(got[q], brute.top(scores, 4, ascending_ties=True))


def test_shuffled_and_broadcast_joins_agree(case):
    index, doc_df, query_df, *_ = case
    ranker = BM25Ranker(index)
    candidates = doc_df.crossJoin(query_df.select("query_id"))

    def results():
        ranked = ranker.rank(query_df, 5, pad_zero=True, texts=doc_df).collect()
        scored = ranker.score_docs(candidates, query_df).collect()
        weights = index.weights().collect()
        return [sorted(map(str, rows)) for rows in (ranked, scored, weights)]

    small = results()
    index.broadcast_limit = 0
    try:
        assert results() == small
    finally:
        index.broadcast_limit = None


def test_score_docs_equals_brute_force(case):
    index, doc_df, query_df, tokens, queries = case
    model = brute.Corpus(tokens)
    unseen = doc_df.select(
        (F.col("doc_id") + 1000).alias("doc_id"), F.concat_ws(" ", "text", F.lit("new w1")).alias("text")
    )
    candidates = doc_df.union(unseen).crossJoin(query_df.select("query_id"))
    texts = {d: t for d, t in tokens.items()}
    texts.update({d + 1000: t + ["new", "w1"] for d, t in tokens.items()})
    bm25 = BM25Ranker(index).score_docs(candidates, query_df).collect()
    tfidf = TfidfRanker(index).score_docs(candidates, query_df).collect()
    assert len(bm25) == len(tfidf) == len(texts) * len(queries)
    for r in bm25:
        want = model.bm25(queries[r["query_id"]], texts[r["doc_id"]])
        assert r["predicted_score"] == pytest.approx(want)
    for r in tfidf:
        want = model.tfidf(queries[r["query_id"]], texts[r["doc_id"]], repeats=True)
        assert r["predicted_score"] == pytest.approx(want)


def test_score_docs_keeps_copies_and_unknown_queries(case, spark):
    index, *_ = case
    rows = [(0, "w1 w2"), (0, "w1 w2"), (99, "w1"), (None, "w1"), (0, None)]
    candidates = spark.createDataFrame(rows, "query_id long, text string")
    queries = spark.createDataFrame([(0, "w1")], "query_id long, query string")
    got = BM25Ranker(index).score_docs(candidates, queries).collect()
    scores = [(r["query_id"], r["predicted_score"] > 0) for r in got]
    assert sorted(scores, key=str) == sorted(
        [(0, True), (0, True), (99, False), (None, False), (0, False)], key=str
    )


def test_variants_in_one_pass(case):
    index, _, query_df, *_ = case
    variants = {"plain": BM25Ranker(index, delta=0.0), "plus": BM25Ranker(index)}
    rows = score_variants(index, variants, query_df)
    wide = rows.groupBy("query_id", "doc_id").pivot("variant", ["plain", "plus"]).sum("score")
    assert wide.where("plus < plain or plain < 0").count() == 0
    alone = BM25Ranker(index).score(query_df).withColumnRenamed("score", "alone")
    joined = wide.join(alone, ["query_id", "doc_id"])
    assert joined.count() == alone.count() == wide.count()
    assert joined.where("abs(plus - alone) > 1e-9").count() == 0


def test_single_query_string(case):
    index, _, _, tokens, _ = case
    model = brute.Corpus(tokens)
    got = _ranked(BM25Ranker(index).rank("w1 w2 w2", 5))[0]
    scores = {d: s for d, t in tokens.items() if (s := model.bm25(["w1", "w2", "w2"], t)) > 0}
    _same_ranking(got, brute.top(scores, 5))
    dense = BM25Ranker(index).score_all("w1 w2 w2").collect()
    assert {r["doc_id"] for r in dense} == set(tokens)
    for r in dense:
        assert r["score"] == pytest.approx(model.bm25(["w1", "w2", "w2"], tokens[r["doc_id"]]))


def test_bm25_fixed_values(spark):
    docs = [(0, "red shoe red"), (1, "blue shoe"), (2, "green hat box tall")]
    index = CorpusIndex.fit(spark.createDataFrame(docs, "doc_id long, text string"))
    ranker = BM25Ranker(index)
    got = _ranked(ranker.rank("red shoe", 3, pad_zero=True))[0]
    assert got == [(1, 0, 3.2695), (2, 1, 1.0142), (3, 2, 0.0)]
    assert _ranked(ranker.rank("red red shoe", 1))[0] == [(1, 0, 5.5989)]


def test_search_fixed_values(spark):
    # Eight documents with the lengths and counts of the fixed values; "f" is a filler.
    def doc(length, **counts):
        words = [w for w, n in counts.items() for _ in range(n)]
        return " ".join(words + ["f"] * (length - len(words)))

    docs = [
        doc(7, dog=1), doc(15, dog=3, a=3), doc(35, dog=4, document=1), doc(4, a=1),
        doc(4, a=1), doc(7, about=1), doc(4, a=1), doc(6, a=1),
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    index = CorpusIndex.fit(df, tokenizer="whitespace")
    ranker = TfidfRanker(index, count_repeats=True)
    dense = ranker.score_all("document about a dog").orderBy("doc_id").collect()
    want = [0.1932, 0.5057, 0.2018, 0.2940, 0.2940, 0.2362, 0.2940, 0.1960]
    assert [r["score"] for r in dense] == pytest.approx(want, abs=6e-5)
    top = _ranked(ranker.rank("document about a dog", 3, ties="asc"))[0]
    assert [d for _, d, _ in top] == [1, 3, 4]
    dog = index.weights().where("term = 'dog'").orderBy("doc_id").collect()
    assert [r["weight"] for r in dog] == pytest.approx([0.1932, 0.2704, 0.1545], abs=6e-5)


def test_results_do_not_depend_on_partitions(case):
    index, doc_df, query_df, *_ = case
    again = CorpusIndex.fit(doc_df.repartition(13), n_buckets=3)
    a = BM25Ranker(index).rank(query_df, 5, pad_zero=True).collect()
    b = BM25Ranker(again).rank(query_df.repartition(3), 5, pad_zero=True).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_unknown_settings(case):
    index, _, query_df, *_ = case
    with pytest.raises(ValueError):
        TfidfRanker(index, "cosine")
    with pytest.raises(ValueError):
        TfidfRanker(index, "boolean", "max")
    with pytest.raises(ValueError):
        BM25Ranker(index).rank(query_df, ties="random")


def test_small_scores_keep_their_order(spark):
    filler = " ".join(["pad"] * 99_999)
    docs = [(1, "red red red " + filler * 1), (2, "red " + filler)] + [(i, "pad") for i in range(3, 6)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    ranker = TfidfRanker(CorpusIndex.fit(df))
    scores = {r["doc_id"]: r["score"] for r in ranker.score("red").collect()}
    assert 0 < scores[2] < scores[1] < 1e-4
    assert [r["doc_id"] for r in ranker.rank("red", 1).collect()] == [1]
    tiny = spark.createDataFrame([(0, 1, 3.7e-7), (0, 2, 1.2e-7)], "query_id long, doc_id long, score double")
    assert [r["doc_id"] for r in top_documents(tiny, 1).collect()] == [1]


def test_scores_that_differ_by_rounding_only_are_ties(spark):
    rows = [(0, 1, 0.1 + 0.2), (0, 2, 0.3)]
    df = spark.createDataFrame(rows, "query_id long, doc_id long, score double")
    assert [r["doc_id"] for r in top_documents(df, 1).collect()] == [2]


def test_scores_of_many_queries_come_in_batches(case, monkeypatch):
    index, _, query_df, *_ = case

    def found():
        ranker = BM25Ranker(index)
        scores = ranker.score(query_df)
        swept = score_variants(index, {"a": ranker, "b": TfidfRanker(index)}, query_df)
        plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (scores, swept)]
        rows = {tuple(r)[:-1]: r["score"] for df in (scores, swept) for r in df.collect()}
        return plans, rows

    at_once, want = found()
    monkeypatch.setattr("tallyrank.operators.index.QUERIES_PER_BATCH", 2)
    batched, got = found()
    assert not any("Union" in plan for plan in at_once)
    assert all("Union" in plan for plan in batched)
    assert got == pytest.approx(want)


@pytest.mark.parametrize("limit", [0, 5, None])
def test_weights_leave_postings_of_frequent_terms_in_place(case, limit):
    index, _, _, tokens, _ = case
    want = {(r["doc_id"], r["term"]): r["weight"] for r in index.weights().collect()}
    index.broadcast_limit = limit
    try:
        weights = index.weights()
        plan = weights._jdf.queryExecution().optimizedPlan().toString()
        got = weights.collect()
    finally:
        index.broadcast_limit = None
    assert {(r["doc_id"], r["term"]): r["weight"] for r in got} == pytest.approx(want)
    assert len(got) == len(want) == sum(len(set(t)) for t in tokens.values())
    assert ("LeftAnti" in plan) == (limit == 5)


def test_candidates_are_cut_into_tokens_after_the_join(case):
    index, doc_df, query_df, *_ = case
    candidates = doc_df.withColumn("query_id", F.col("doc_id") % 8)
    index.broadcast_limit = 0
    try:
        scored = BM25Ranker(index).score_docs(candidates, query_df)
        plan = scored._jdf.queryExecution().optimizedPlan().toString()
    finally:
        index.broadcast_limit = None
    # What is split lies above the join that moves the candidates by query.
    joined = next(i for i, line in enumerate(plan.splitlines()) if "Join LeftOuter" in line)
    assert any("_tokens" in line for line in plan.splitlines()[:joined])
    assert not any("AS _tokens" in line for line in plan.splitlines()[joined:])
