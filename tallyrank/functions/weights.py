"""Term weights, as columns. All logarithm bases and constants are part of the results."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the variants.
TF_METHODS = ("normalized", "boolean", "summation", "log_scaled")
IDF_METHODS = ("standard", "smoothed")

SCORE_DIGITS = 4


def rank_key(score: Column) -> Column:
    """What scores are ordered by: their first 24 significant bits (7 digits).

    The order of a floating-point sum then cannot change a ranking, and scores of any size
    keep their order, however small the weights of a large corpus become.
    """
    return score.cast("float")


def tf_weight(method: str, tf: Column, dl: Column) -> Column:
    if method == "normalized":
        return F.when(dl > 0, tf / dl).otherwise(F.lit(0.0))
    if method == "boolean":
        return F.when(tf > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    if method == "summation":
        return tf.cast("double")
    if method == "log_scaled":
        return F.log10(1 + tf)
    raise ValueError(f"unknown TF method {method!r}, expected one of {TF_METHODS}")


def idf_weight(method: str, n_docs: Column, df: Column) -> Column:
    if method == "standard":
        return F.when(n_docs > 0, F.log10(n_docs / F.greatest(df, F.lit(1)))).otherwise(F.lit(0.0))
    if method == "smoothed":
        return F.log10((n_docs + 1) / (df + 1)) + 1
    raise ValueError(f"unknown IDF method {method!r}, expected one of {IDF_METHODS}")


def idf_standard_or_zero(n_docs: Column, df: Column) -> Column:
    """Standard IDF of a word looked up directly: a word in no document gets 0."""
    return F.when(df > 0, idf_weight("standard", n_docs, df)).otherwise(F.lit(0.0))


def idf_bm25(n_docs: Column, df: Column) -> Column:
    return F.ln((n_docs - df + 0.5) / (df + 0.5) + 1)


def bm25_weight(
    tf: Column, dl: Column, avgdl: Column, idf: Column, k: float, b: float, delta: float
) -> Column:
    """BM25+ weight of one term in one document; ``delta`` counts only where tf > 0."""
    norm = F.lit(k) * (F.lit(1.0 - b) + F.lit(b) * (dl / avgdl))
    gain = F.lit(delta) + tf * F.lit(k + 1.0) / (tf + norm)
    return F.when((tf > 0) & (avgdl > 0), idf * gain).otherwise(F.lit(0.0))


def discounted(gain: Column, rank: Column) -> Column:
    """Linear gain divided by log2(rank + 1)."""
    return gain / F.log2(rank + 1)


# The same weights over arrays, for tasks that hold many postings of a term at once.


def tf_weights(
    method: str, tf: np.ndarray, dl: np.ndarray, idf: np.ndarray, avgdl: float
) -> np.ndarray:
    if method == "normalized":
        share = np.divide(tf, dl, out=np.zeros(len(tf)), where=dl > 0)
    elif method == "boolean":
        share = (tf > 0).astype(np.float64)
    else:
        share = tf if method == "summation" else np.log10(1 + tf)
    return share * idf


def bm25_weights(
    k: float, b: float, delta: float, tf: np.ndarray, dl: np.ndarray, idf: np.ndarray, avgdl: float
) -> np.ndarray:
    if avgdl <= 0:
        return np.zeros(len(tf))
    norm = k * ((1.0 - b) + b * (dl / avgdl))
    return idf * (delta + tf * (k + 1.0) / (tf + norm))
