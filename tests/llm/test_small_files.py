"""Scratch tables of short rows are few files, however finely a shuffle deals its rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyrank.llm import bpe, exact_dedup, registry, simhash, toxicity
from tallyrank.sources import scratch

PARTITIONS = 64
SETTINGS = {
    "spark.sql.shuffle.partitions": str(PARTITIONS),
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def finely_dealt(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield max(2 * spark.sparkContext.defaultParallelism, PARTITIONS // 16)
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def files(monkeypatch):
    """The number of files of each scratch table that is written, largest by label."""
    found: dict[str, int] = {}

    def write(df, label):
        table = scratch.materialize(df, label)
        found[label] = max(found.get(label, 0), len(table.inputFiles()))
        return table

    for module in (bpe, exact_dedup, simhash, toxicity):
        monkeypatch.setattr(module, "materialize", write)
    return found


@pytest.fixture
def docs(spark):
    rng = random.Random(17)
    words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(900)]
    passage = " ".join(rng.choices(words, k=700))  # chunks that many documents share
    rows = []
    for i in range(400):
        text = " ".join(rng.choices(words, k=40))
        if i % 2:
            # Many fingerprints some bits apart, and chunks of their own that two documents share.
            text = f"{passage} {rows[-1][1]} w{i % 7}"
        rows.append((i, text if i % 9 else f"you idiot moron {text}", int(i % 9 == 0)))
    rows += [(1000, rows[0][1], 0), (None, None, 0), (1001, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    return df.select("doc_id", "text"), df.select("doc_id", "toxic"), len(rows)


def test_copies(finely_dealt, files, docs):
    kept = exact_dedup.drop_duplicates(docs[0], keep="largest")
    assert kept.count() == docs[0].select(F.coalesce("text", F.lit(""))).distinct().count()
    assert 0 < files["kept"] <= finely_dealt


def test_near_copies(spark, finely_dealt, files, docs):
    rng = random.Random(18)
    prints = [rng.getrandbits(60) for _ in range(300)]
    pairs = [(p, p ^ 1 << 61) for p in prints]
    links = spark.createDataFrame(pairs, "fp long, hub long").repartition(PARTITIONS, "fp")
    assert simhash.components(links).count() == len(set(prints))
    assert 0 < files["links"] <= finely_dealt and 0 < files["stars"] <= finely_dealt
    simhash.drop_near_duplicates(docs[0]).count()
    assert 0 < files["rooted"] <= finely_dealt and 0 < files["kept"] <= finely_dealt


def test_lexicon(finely_dealt, files, docs):
    model = toxicity.train(*docs[:2], F.lit(True))
    assert model.weights["idiot*"] > 0
    assert {"labelled", "different", "entries", "met", "shingles"} <= set(files)
    for label in ("labelled", "different", "entries", "met", "shingles"):
        assert files[label] <= finely_dealt, label


def test_chunks(finely_dealt, files, docs):
    coded = bpe.encode(docs[0], registry.tokenizer_spec())
    assert coded.count() == docs[2]
    assert 0 < files["shared"] <= finely_dealt and 0 < files["encoded-chunks"] <= finely_dealt
