"""Declared schemas of every table that is read or written, and the column check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_STR, _LONG, _INT, _DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

# The column names below are those of the files that are read and written.
EXAMPLES = _struct(
    query_id=_LONG,
    query=_STR,
    product_id=_STR,
    product_locale=_STR,
    small_version=_INT,
    esci_label=_STR,
    split=_STR,
)

PRODUCT_TEXT_COLUMNS = (
    "product_title",
    "product_description",
    "product_bullet_point",
    "product_brand",
    "product_color",
)

PRODUCTS = _struct(
    product_id=_STR,
    product_locale=_STR,
    **{name: _STR for name in PRODUCT_TEXT_COLUMNS},
)

PROCESSED = _struct(
    query_id=_LONG,
    product_id=_STR,
    clean_query=_STR,
    clean_product_document=_STR,
    relevance_score=_DOUBLE,
    split=_STR,
)

PREDICTIONS = _struct(
    model=_STR,
    query_id=_LONG,
    product_id=_STR,
    predicted_score=_DOUBLE,
    relevance_score=_DOUBLE,
)

SUMMARY = _struct(model=_STR, ndcg_at_k=_DOUBLE)

TERMS = _struct(
    term=_STR,
    df=_LONG,
    cf=_LONG,
    max_tf=_LONG,
    max_share=_DOUBLE,
    idf_standard=_DOUBLE,
    idf_smoothed=_DOUBLE,
    idf_bm25=_DOUBLE,
)

CORPUS_STATS = _struct(n_docs=_LONG, total_tokens=_LONG, avgdl=_DOUBLE)

LEMMA_MAP = _struct(form=_STR, lemma=_STR)


def require_columns(df: DataFrame, required) -> DataFrame:
    """Return ``df`` unchanged, or raise ``ValueError`` naming the missing columns."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"columns not found: {missing}; got {df.columns}")
    return df
