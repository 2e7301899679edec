"""Corpus statistics as long tables: postings, term statistics, vocabulary, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrank.functions import weights
from tallyrank.sources.scratch import materialize


def token_runs(df: DataFrame, tokens: str, runs: str = "runs") -> DataFrame:
    """Replace a token array by its distinct tokens with counts, and add the length ``dl``.

    The array is sorted and cut into runs inside the row: no shuffle, and no memory beyond
    the row. The result column is an array of (term, tf), ordered by term.
    """
    keep = [c for c in df.columns if c != tokens]
    ordered = df.withColumn("_sorted", F.sort_array(tokens)).select(
        *keep, "_sorted", F.size("_sorted").alias("_dl")
    )
    word = F.col("_sorted")

    def starts_run(i: Column) -> Column:
        return (i == 0) | (word[i] != word[F.greatest(i - 1, F.lit(0))])

    starts = F.when(
        F.col("_dl") > 0, F.filter(F.sequence(F.lit(0), F.col("_dl") - 1), starts_run)
    ).otherwise(F.array().cast("array<int>"))

    def run(start: Column, i: Column) -> Column:
        end = F.coalesce(F.get("_starts", i + 1), F.col("_dl"))
        return F.struct(word[start].alias("term"), (end - start).cast("long").alias("tf"))

    return ordered.withColumn("_starts", starts).select(
        *keep, F.col("_dl").cast("long").alias("dl"), F.transform("_starts", run).alias(runs)
    )


def term_counts(df: DataFrame, tokens: str, tf: str = "tf") -> DataFrame:
    """One row per distinct token of each input row: ``term``, its count, the length ``dl``.

    The other columns of ``df`` are kept. A row without tokens gives one row with a NULL
    term, so that nothing is lost; drop those where only postings are wanted.
    """
    keep = [c for c in df.columns if c != tokens]
    return explode_runs(token_runs(df, tokens), "runs", tf).select(*keep, "term", tf, "dl")


def explode_runs(df: DataFrame, runs: str, tf: str = "tf") -> DataFrame:
    """One row per run of ``token_runs``; a row without runs gives one with a NULL term."""
    keep = [c for c in df.columns if c not in (runs, "dl")]
    exploded = df.select(*keep, "dl", F.explode_outer(runs).alias("_run"))
    return exploded.select(
        *keep,
        F.col("_run.term").alias("term"),
        F.coalesce("_run.tf", F.lit(0)).alias(tf),
        "dl",
    )


def document_frequency(postings: DataFrame) -> DataFrame:
    """Number of documents per term; postings hold a term once per document."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def term_statistics(postings: DataFrame) -> DataFrame:
    """Per term: documents, occurrences, and the largest count and share in one document."""
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"),
        F.sum("tf").alias("cf"),
        F.max("tf").alias("max_tf"),
        F.max(F.col("tf") / F.col("dl")).alias("max_share"),
    )


def collection_frequency(terms: DataFrame, stats: DataFrame) -> DataFrame:
    """Number of occurrences per term and their share of all tokens, from a fitted index."""
    total = stats.select("total_tokens").scalar()
    return terms.select(
        "term", F.col("cf").alias("term_count"), (F.col("cf") / total).alias("frequency")
    )


def corpus_stats(doc_stats: DataFrame) -> DataFrame:
    """Number of documents (empty ones too), number of tokens, mean length (0 if empty)."""
    summed = doc_stats.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum("dl"), F.lit(0)).cast("long").alias("total_tokens"),
    )
    return summed.withColumn(
        "avgdl",
        F.when(F.col("n_docs") > 0, F.col("total_tokens") / F.col("n_docs")).otherwise(F.lit(0.0)),
    )


def with_idf(df: DataFrame, n_docs: Column) -> DataFrame:
    return df.select(
        "*",
        weights.idf_weight("standard", n_docs, F.col("df")).alias("idf_standard"),
        weights.idf_weight("smoothed", n_docs, F.col("df")).alias("idf_smoothed"),
        weights.idf_bm25(n_docs, F.col("df")).alias("idf_bm25"),
    )


def idf_curve(corpus: DataFrame) -> DataFrame:
    """Both TF-IDF IDFs for every possible document frequency, 1 to the corpus size."""
    n_docs = corpus.agg(F.count(F.lit(1)).alias("n_docs"))
    # The corpus size is one number; range() then spreads the rows over all tasks.
    size = n_docs.first()["n_docs"]
    n = F.lit(size)
    return corpus.sparkSession.range(1, size + 1).select(
        F.col("id").alias("df"),
        weights.idf_standard_or_zero(n, F.col("id")).alias("idf_standard"),
        weights.idf_weight("smoothed", n, F.col("id")).alias("idf_smoothed"),
    )


def distinct_documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per distinct non-empty text, under its smallest id.

    Copies collapse on the map side, so a text that fills a third of the table costs one
    row per task.
    """
    return (
        docs.where(F.col(text_col).isNotNull() & (F.col(text_col) != ""))
        .groupBy(text_col)
        .agg(F.min(id_col).alias(id_col))
        .select(id_col, text_col)
    )


def first_occurrence(docs: DataFrame, tokens: Column, id_col: str = "doc_id") -> DataFrame:
    """Per term the first document that holds it, and its place among that document's terms.

    Distinct tokens keep their order, so the place orders terms as their first positions do.
    """
    placed = docs.select(
        F.col(id_col).alias("doc_id"),
        F.posexplode(F.array_distinct(tokens)).alias("place", "term"),
    )
    return placed.groupBy("term").agg(
        F.min_by("place", "doc_id").alias("place"), F.min("doc_id").alias("doc_id")
    )


def with_dense_index(df: DataFrame, order: list[str], index: str = "term_index") -> DataFrame:
    """Number the rows 0, 1, 2, ... by ``order`` without a global sort in one task.

    Rows are range-partitioned and numbered inside each partition; the partition sizes
    (one row per task) give the offsets. The numbered table is written first, because the
    two uses must see the same partitions.
    """
    numbered = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_local"),
        ),
        "vocabulary",
    )
    # One row per partition of the range shuffle, however large the table is.
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(index, F.col("_offset") + F.col("_local"))
        .drop("_part", "_local", "_offset")
    )


def collection_lookup(terms: DataFrame, stats: DataFrame, words: DataFrame) -> DataFrame:
    """Collection counts and frequencies of ``words(term)``, taken literally: a word that
    normalization would change is not found and counts 0."""
    total = stats.select("total_tokens").scalar()
    words = words.select("term").distinct()
    counted = words.join(terms.select("term", "cf"), "term", "left").select(
        "term", F.coalesce("cf", F.lit(0)).alias("term_count")
    )
    share = F.when(total > 0, F.col("term_count") / total).otherwise(F.lit(0.0))
    return counted.withColumn("frequency", share)
