"""Fit on the training split, predict the test split, evaluate."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyrank import schemas
from tallyrank.operators.evaluate import evaluate, predict_models
from tallyrank.operators.index import CorpusIndex
from tallyrank.operators.rankers import BM25Ranker, Ranker, TfidfRanker
from tallyrank.operators.sampling import sample_rows
from tallyrank.sources.scratch import materialize

TRAIN, TEST = "train", "test"


def fit(
    train: DataFrame,
    model_dir: str,
    *,
    overwrite: bool = False,
    lemmas: DataFrame | None = None,
    n_buckets: int | None = None,
) -> CorpusIndex:
    """Fit both models on the distinct documents of ``train``.

    They differ in their weights only, so they share one index. An index that exists is
    reused unless ``overwrite`` is set.
    """
    if not overwrite and CorpusIndex.exists(train.sparkSession, model_dir):
        return CorpusIndex.load(train.sparkSession, model_dir)
    texts = train.select("clean_product_document").where("clean_product_document <> ''")
    # One product can stand for several texts, so a document is known by its text.
    corpus = texts.distinct().selectExpr(
        "sha2(clean_product_document, 256) AS doc_id", "clean_product_document AS text"
    )
    corpus = materialize(corpus, "training-corpus")
    # Experiments score given candidates; nothing is ranked over the corpus.
    return CorpusIndex.fit(corpus, model_dir, lemmas=lemmas, n_buckets=n_buckets, ranked=False)


def rankers(index: CorpusIndex) -> dict[str, Ranker]:
    return {"tfidf": TfidfRanker(index), "bm25": BM25Ranker(index)}


def run(
    processed: DataFrame,
    model_dir: str,
    *,
    do_fit: bool = True,
    do_predict: bool = True,
    overwrite: bool = False,
    train_size: int | None = None,
    test_size: int | None = None,
    k: int = 10,
    seed: int = 42,
    order: list[str] | None = None,
    lemmas: DataFrame | None = None,
) -> DataFrame | None:
    """The whole experiment; returns the summary, or None without ``do_predict``.

    All rows count. ``train_size`` and ``test_size`` sample rows only when they are given; a
    sampled test set has shorter candidate lists, which raises NDCG. ``order`` fixes the order
    of the rows of a query.
    """
    schemas.require_columns(processed, schemas.PROCESSED.fieldNames())
    order = order or ["product_id"]
    keys = ["query_id", *order, "clean_product_document"]

    def part(split: str, size: int | None) -> DataFrame:
        rows = processed.where(processed["split"] == split)
        return rows if size is None else sample_rows(rows, size, keys, seed)

    spark = processed.sparkSession
    if do_fit:
        fit(part(TRAIN, train_size), model_dir, overwrite=overwrite, lemmas=lemmas)
    if not do_predict:
        return None
    models = rankers(CorpusIndex.load(spark, model_dir))
    predictions = predict_models(models, part(TEST, test_size), order=order)
    # Read three times by the evaluation.
    predictions = materialize(predictions, "predictions")
    return evaluate(predictions, k, ties=order)
