from __future__ import annotations

import brute
import pytest
from pyspark.sql import functions as F

from tallyrank.functions.text import STOPWORDS
from tallyrank.operators import lemma, skew
from tallyrank.operators.index import CorpusIndex
from tallyrank.operators.rankers import BM25Ranker

NOUNS = ["dog", "box", "boss", "wolf", "man", "city", "church", "foot", "ha", "in", "bus", "gas", "ga"]
EXCEPTIONS = [("feet", "foot"), ("buses", "bus")]
MAP = {
    "dogs": "dog", "boxes": "box", "boss": "boss", "wolves": "wolf", "men": "man",
    "cities": "city", "churches": "church", "feet": "foot", "buses": "bus", "has": "ha",
    "ins": "in", "gas": "ga", "runs": "runs", "dog": "dog",
}


@pytest.fixture(scope="module")
def lemmas(spark):
    forms = spark.createDataFrame([(f,) for f in MAP], "form string")
    nouns = spark.createDataFrame([(n,) for n in NOUNS], "word string")
    exceptions = spark.createDataFrame(EXCEPTIONS, "form string, lemma string")
    return lemma.lemma_map(forms, nouns, exceptions)


def _apply(tokens: list[str], passes: int) -> list[str]:
    for _ in range(passes):
        tokens = [MAP.get(t, t) for t in tokens if t not in STOPWORDS]
    return tokens


def test_lemma_map(lemmas):
    assert {r["form"]: r["lemma"] for r in lemmas.collect()} == MAP


def test_corpus_map_uses_the_vocabulary(spark):
    forms = spark.createDataFrame([("dog",), ("dogs",), ("cats",)], "form string")
    got = {r["form"]: r["lemma"] for r in lemma.corpus_lemma_map(forms).collect()}
    assert got == {"dog": "dog", "dogs": "dog", "cats": "cats"}


def test_effective_map_drops_a_lemma_that_is_a_stopword(lemmas):
    once = {r["form"]: r["lemma"] for r in lemma.effective_map(lemmas, 1).collect()}
    twice = {r["form"]: r["lemma"] for r in lemma.effective_map(lemmas, 2).collect()}
    assert once["ins"] == "in" and twice["ins"] is None
    assert twice["dogs"] == "dog" and "dog" not in twice
    with pytest.raises(ValueError):
        lemma.effective_map(lemmas, 0)


@pytest.mark.parametrize("limit", [None, 0])
def test_joined_lemmas_keep_order_and_repeats(spark, lemmas, limit):
    texts = spark.createDataFrame(
        [("a", ["dogs", "runs", "dogs", "ins"]), ("b", []), ("a", ["dogs", "runs", "dogs", "ins"])],
        "digest string, tokens array<string>",
    )
    effective = lemma.effective_map(lemmas, 2)
    got = lemma.join_lemmas(texts, effective, 0 if limit is None else None).collect()
    assert {tuple(r) for r in got} == {("a", "dog runs dog"), ("b", "")}


@pytest.mark.parametrize("passes", [1, 2])
@pytest.mark.parametrize("broadcast", [True, False])
def test_ranking_with_lemmas_equals_brute_force(spark, lemmas, passes, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr("tallyrank.operators.skew.BROADCAST_ROWS", 0)
    docs = {
        0: "the dogs and the dog", 1: "dog boxes has ins", 2: "ins", 3: "", 4: "wolves men cities",
        5: "box ha feet foot feet", 6: "gas buses",
    }
    queries = {0: "dogs dog boxes", 1: "ins dog", 2: "foot has", 3: "gas wolf man"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    qdf = spark.createDataFrame(list(queries.items()), "query_id long, query string")
    index = CorpusIndex.fit(df, lemmas=lemmas, passes=passes)
    tokens = {d: _apply(brute.split(t), passes) for d, t in docs.items()}
    model = brute.Corpus(tokens)
    assert {r["doc_id"]: r["dl"] for r in index.doc_stats.collect()} == {
        d: len(t) for d, t in tokens.items()
    }
    assert index.stats.first()["avgdl"] == pytest.approx(model.avgdl)
    candidates = df.crossJoin(qdf.select("query_id"))
    for r in BM25Ranker(index).score_docs(candidates, qdf).collect():
        query = _apply(brute.split(queries[r["query_id"]]), passes)
        assert r["predicted_score"] == pytest.approx(model.bm25(query, tokens[r["doc_id"]]))
    scores = {
        (r["query_id"], r["doc_id"]): r["score"] for r in BM25Ranker(index).score(qdf).collect()
    }
    for q, text in queries.items():
        query = _apply(brute.split(text), passes)
        for d, t in tokens.items():
            assert scores.get((q, d), 0.0) == pytest.approx(model.bm25(query, t))


def test_a_form_listed_twice_counts_once(spark):
    rows = [("axes", "axe"), ("axes", "axis"), ("boxes", "box")]
    lemmas = spark.createDataFrame(rows, "form string, lemma string")
    docs = spark.createDataFrame([(1, "axes box"), (2, "")], "doc_id long, text string")
    index = CorpusIndex.fit(docs, lemmas=lemmas)
    assert {r["doc_id"]: r["dl"] for r in index.doc_stats.collect()} == {1: 2, 2: 0}
    queries = spark.createDataFrame([(0, "axes")], "query_id long, query string")
    asked = docs.withColumn("query_id", F.lit(0).cast("long"))
    scored = BM25Ranker(index).score_docs(asked, queries).collect()
    assert len(scored) == 2


@pytest.mark.parametrize("forms", [3, 400])
def test_dropped_forms_do_not_count_as_length(spark, forms):
    lemmas = spark.createDataFrame(
        [(f"thes{i}", "these") for i in range(forms)] + [("these", "the"), ("axes", "axe")],
        "form string, lemma string",
    )
    text = " ".join(f"thes{i}" for i in range(forms)) + " axes wood"
    docs = spark.createDataFrame([(1, text), (2, "axe"), (3, "")], "doc_id long, text string")
    index = CorpusIndex.fit(docs, lemmas=lemmas, passes=3)
    assert {r["doc_id"]: r["dl"] for r in index.doc_stats.collect()} == {1: 2, 2: 1, 3: 0}
    queries = spark.createDataFrame([(0, "axe")], "query_id long, query string")
    asked = docs.withColumn("query_id", F.lit(0).cast("long"))
    ranker = BM25Ranker(index)
    got = {r["doc_id"]: r["predicted_score"] for r in ranker.score_docs(asked, queries).collect()}
    want = {r["doc_id"]: r["score"] for r in ranker.score_all("axe").collect()}
    assert got == pytest.approx(want)


def test_lemmas_beyond_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    rows = [(i, "boxes boxes word" if i % 3 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lemmas = spark.createDataFrame([("boxes", "box")], "form string, lemma string")
    index = CorpusIndex.fit(docs, lemmas=lemmas, n_buckets=4)
    assert {r["term"]: r["cf"] for r in index.terms.collect()} == {"box": 400, "word": 200}
    assert index.doc_stats.where("dl = 0").count() == 100
