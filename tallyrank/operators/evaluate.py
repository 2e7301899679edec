"""Predictions for labelled candidates and NDCG@k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrank.functions import weights
from tallyrank.operators.rankers import Ranker, score_candidates


def first_queries(test: DataFrame, order: list[str]) -> DataFrame:
    """(query_id, query): the query text of each group's first row by ``order``."""
    return (
        test.where("query_id is not null")
        .groupBy("query_id")
        .agg(F.min_by("clean_query", F.struct(*order)).alias("query"))
    )


def predict_models(
    rankers: dict[str, Ranker], test: DataFrame, *, order: list[str] | None = None
) -> DataFrame:
    """(model, query_id, product_id, predicted_score, relevance_score, ...) per candidate.

    All models score a candidate in the same pass. Rows without a query id are left out.
    Columns of ``test`` beyond the processed schema are kept, for use as tie breakers.
    """
    order = order or ["product_id"]
    test = test.where("query_id is not null")
    scores = {f"_score_{i}": ranker for i, ranker in enumerate(rankers.values())}
    scored = score_candidates(
        scores, test, first_queries(test, order), text_col="clean_product_document"
    )
    per_model = F.array(
        *[
            F.struct(F.lit(name).alias("model"), F.col(f"_score_{i}").alias("predicted_score"))
            for i, name in enumerate(rankers)
        ]
    )
    fixed = ["query_id", "product_id", "relevance_score"]
    text = ["clean_query", "clean_product_document", "split"]
    extra = [c for c in test.columns if c not in fixed + text]
    return scored.select(*fixed, *extra, F.inline(per_model)).select(
        "model", "query_id", "product_id", "predicted_score", "relevance_score", *extra
    )


def predict(
    ranker: Ranker, test: DataFrame, model_name: str, *, order: list[str] | None = None
) -> DataFrame:
    """Predictions of one model."""
    return predict_models({model_name: ranker}, test, order=order)


def union_predictions(*predictions: DataFrame) -> DataFrame:
    result = predictions[0]
    for other in predictions[1:]:
        result = result.unionByName(other)
    return result


def ndcg_per_query(
    predictions: DataFrame, k: int = 10, *, ties: list[str] | None = None
) -> DataFrame:
    """(model, query_id, ndcg): linear gain, log2 discount.

    Equal scores are ordered by ``ties``, descending. A group with a missing relevance, or
    whose best possible gain is not positive, gets 0.0. Both rankings are cut to ``k`` per
    query inside each task before the shuffle, so a query with a large share of all
    candidates is never sorted in one task.
    """
    group = ["model", "query_id"]
    later_first = [F.col(c).desc() for c in (ties or ["product_id"])]
    rows = predictions.where("query_id is not null").withColumn(
        "_score", weights.rank_key(F.col("predicted_score"))
    )
    by_score = Window.partitionBy(*group).orderBy(F.col("_score").desc(), *later_first)
    by_label = Window.partitionBy(*group).orderBy(F.col("relevance_score").desc())
    gain = weights.discounted(F.col("relevance_score"), F.col("_rank"))

    def cut_gain(window, name: str) -> DataFrame:
        cut = rows.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k)
        return cut.groupBy(*group).agg(F.sum(gain).alias(name))

    unlabelled = F.count(F.lit(1)) - F.count("relevance_score")
    missing = rows.groupBy(*group).agg(unlabelled.alias("_missing"))
    joined = missing.join(cut_gain(by_score, "_dcg"), group).join(cut_gain(by_label, "_idcg"), group)
    valid = (F.col("_missing") == 0) & (F.col("_idcg") > 0)
    return joined.select(
        *group, F.when(valid, F.col("_dcg") / F.col("_idcg")).otherwise(F.lit(0.0)).alias("ndcg")
    )


def evaluate(
    predictions: DataFrame, k: int = 10, *, ties: list[str] | None = None
) -> DataFrame:
    """(model, ndcg_at_k): mean over queries, rounded to 4 digits, best model first."""
    mean = F.round(F.avg("ndcg"), weights.SCORE_DIGITS).alias("ndcg_at_k")
    per_query = ndcg_per_query(predictions, k, ties=ties)
    return per_query.groupBy("model").agg(mean).orderBy(F.desc("ndcg_at_k"), "model")
