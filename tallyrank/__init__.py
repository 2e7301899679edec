"""Text ranking and ranking evaluation as Spark DataFrame jobs."""

from tallyrank.operators.evaluate import evaluate, ndcg_per_query, predict, predict_models
from tallyrank.operators.index import CorpusIndex
from tallyrank.operators.rankers import BM25Ranker, Ranker, TfidfRanker
from tallyrank.plans.dataset import build_dataset
from tallyrank.plans.experiment import run
from tallyrank.session import get_spark

__all__ = [
    "BM25Ranker",
    "CorpusIndex",
    "Ranker",
    "TfidfRanker",
    "build_dataset",
    "evaluate",
    "get_spark",
    "ndcg_per_query",
    "predict",
    "predict_models",
    "run",
]
