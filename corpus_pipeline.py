"""The corpus pipeline: documents in, cleaned documents and their tokens out.

Each stage takes (spark, docs, sf_dir) and returns what it kept, with the columns of the
documents; the last adds the tokens. Stages are judged and rerun one by one: their results
are written as Parquet and read again, so nothing is computed twice and a lost executor
costs at most the stage it was in.

Every stage gives the results that its operator defines for nulls, empty and very long texts,
repeated rows, empty tables and further columns (see the modules in ``tallyrank/llm``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrank.llm import bpe, decontaminate, exact_dedup, simhash, toxicity
from tallyrank.llm.common import table
from tallyrank.llm.registry import tokenizer_spec
from tallyrank.sources.scratch import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labels, scores below the threshold."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels, ~toxicity.held_out())
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (but for the case of A to Z) that with the largest id."""
    return exact_dedup.drop_duplicates(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints at most two bits apart that with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; those that are mostly passages go."""
    items = table(spark, sf_dir, "benchmark")
    chars = "n_chars" if "n_chars" in docs.columns else None
    return decontaminate.remove_contamination(docs, items, chars_col=chars)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their tokens (little-endian 32-bit integers) and their number."""
    coded = bpe.encode(docs, tokenizer_spec()).drop("decoded")
    return coded.withColumn("n_tokens", F.floor(F.octet_length("ids") / 4))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", remove_benchmarks),
    ("bpe", tokenize),
]

# Neither the learned lexicon nor merges of tokens can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
