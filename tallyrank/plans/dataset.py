"""From judgements and products to the processed data set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrank.functions import text as text_fn
from tallyrank.operators import lemma
from tallyrank.operators.skew import broadcast_size, hot_keys, lookup_join, shuffle_partitions
from tallyrank.schemas import PRODUCT_TEXT_COLUMNS
from tallyrank.sources.scratch import materialize

# Relevance per label. Irrelevant scores above complement.
RELEVANCE = {"e": 1.0, "s": 0.6, "i": 0.1, "c": 0.0}


def relevance_score(label: Column | str) -> Column:
    """Relevance of a label in any case; NULL for an unknown or missing label."""
    label = F.lower(F.col(label) if isinstance(label, str) else label)
    score = F.lit(None).cast("double")
    for key, value in RELEVANCE.items():
        score = F.when(label == key, F.lit(value)).otherwise(score)
    return score


def product_document() -> Column:
    """The product's text fields in fixed order, missing ones as empty strings."""
    return F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in PRODUCT_TEXT_COLUMNS])


def vocabulary(examples: DataFrame, products: DataFrame) -> DataFrame:
    """(form): all words of the queries and of the product texts."""
    texts = examples.select(F.col("query").alias("text")).unionByName(
        products.select(product_document().alias("text"))
    )
    return texts.select(F.explode(_word_forms("text")).alias("form")).distinct()


def _word_forms(text: Column | str) -> Column:
    return text_fn.raw_tokens(text_fn.strip_tags(text_fn.html_unescape(text)))


def _cleaned(
    df: DataFrame, text: Column, name: str, effective: DataFrame | None
) -> DataFrame:
    """``df`` with the cleaned ``text``. With lemmas each different text is cleaned once.

    The cleaned texts are a written table, whose size decides how the rows get them back.
    """
    if effective is None:
        return df.withColumn(name, text_fn.clean_text(text))
    keyed = df.withColumn("_digest", lemma.text_digest(text)).withColumn("_text", text)
    distinct = keyed.select(F.col("_digest").alias("digest"), "_text").dropDuplicates(["digest"])
    texts = distinct.select("digest", _word_forms("_text").alias("tokens"))
    clean = materialize(
        lemma.join_lemmas(texts, effective, **broadcast_size(effective)), "clean-texts"
    )
    copies = keyed.groupBy("_digest").agg(F.count(F.lit(1)).alias("_rows"))
    return lookup_join(
        keyed.drop("_text"),
        clean.select(F.col("digest").alias("_digest"), F.col("clean").alias(name)),
        ["_digest"],
        "left",
        **broadcast_size(clean.select("clean")),
        hot=hot_keys(copies, ["_digest"], "_rows", shuffle_partitions(df.sparkSession)),
        spread_by=[F.col(c) for c in df.columns],
    ).drop("_digest")


def build_dataset(
    examples: DataFrame,
    products: DataFrame,
    *,
    locale: str = "us",
    lemmas: DataFrame | None = None,
    extra: list[str] | None = None,
) -> DataFrame:
    """The processed data set; ``extra`` names columns of ``examples`` to keep as well.

    Products and queries are cleaned before the join, so a product's text is handled once
    and not once per judgement. A judgement without a product has an empty document. A
    product with a large share of the judgements is split by the adaptive skew join.
    """
    extra = extra or []
    if lemmas is not None:
        lemmas = materialize(lemma.effective_map(lemmas), "lemmas")
    judged = examples.where((F.col("small_version") == 1) & (F.col("product_locale") == locale))
    judged = judged.select(
        "query_id",
        "product_id",
        "product_locale",
        "query",
        relevance_score("esci_label").alias("relevance_score"),
        "split",
        *extra,
    )
    judged = _cleaned(judged, F.col("query"), "clean_query", lemmas).drop("query")
    documents = _cleaned(
        products.where(F.col("product_locale") == locale).select(
            "product_id", "product_locale", product_document().alias("_document")
        ),
        F.col("_document"),
        "clean_product_document",
        lemmas,
    ).drop("_document")
    joined = judged.join(documents, ["product_locale", "product_id"], "left")
    return joined.select(
        "query_id",
        "product_id",
        "clean_query",
        F.coalesce("clean_product_document", F.lit("")).alias("clean_product_document"),
        "relevance_score",
        "split",
        *extra,
    )
