"""Exact dedup, sharding and chat formatting against plain Python."""

from __future__ import annotations

import hashlib
import random
import time
import zlib

import pytest

from tallyrank.llm import chat, exact_dedup, sharding

DOCS = "doc_id long, text string, row string, n int"


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    texts = ["", None, "Same text", "same TEXT", "Straße É", "straße É", "x" * 300_000]
    rows = [(i, rng.choice(texts), f"r{i % 3}", i % 2) for i in range(300)]
    rows += [(None, "same text", "a", 1), (None, "only null", "a", 1), (None, "only null", "b", 1)]
    rows += [(900, "twice", "a", 1)] * 3 + [(901, "tie", "a", 1), (901, "tie", "b", 1)]
    return spark.createDataFrame(rows, DOCS).repartition(5), rows


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup_equals_plain_grouping(docs, keep):
    df, rows = docs
    groups: dict[str, list] = {}
    for row in rows:
        groups.setdefault(_lower(row[1]), []).append(row)
    found = exact_dedup.mark_duplicates(df, keep=keep).collect()
    assert len(found) == len(rows)
    by_digest: dict[str, list] = {}
    for row in found:
        by_digest.setdefault(row["text_sha256"], []).append(row)
    for text, members in groups.items():
        got = by_digest[hashlib.sha256(text.encode()).hexdigest()]
        ids = [m[0] for m in members if m[0] is not None]
        best = (max(ids) if keep == "largest" else min(ids)) if ids else None
        assert {(r["keep_id"], r["group_size"]) for r in got} == {(best, len(members))}
        assert [r["id"] for r in got if r["kept"]] == [best]


def test_dropping_keeps_whole_rows_and_clashing_columns(docs):
    df, rows = docs
    for name in ("digest", "_salt", "node"):
        df = df.withColumnRenamed("n", name) if name == "digest" else df
    kept = exact_dedup.drop_duplicates(df, keep="largest")
    assert kept.columns == df.columns
    got = kept.collect()
    assert len(got) == len({_lower(r[1]) for r in rows})
    assert {tuple(r) for r in got} <= set(rows)
    assert exact_dedup.drop_duplicates(df.limit(0)).count() == 0


def test_keep_is_checked(docs):
    with pytest.raises(ValueError, match="keep"):
        exact_dedup.mark_duplicates(docs[0], keep="any")


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards_equal_prefix_sums(docs, shards):
    df, rows = docs
    got = sharding.assign_shards(df, shards, partitions=6).orderBy("first_byte").collect()
    assert len(got) == len(rows)
    total = sum(len((r[1] or "").encode()) + 16 for r in rows)
    at, slots, last = 0, {}, None
    for r in got:
        assert r["first_byte"] == at
        assert r["shard"] == (2 * at + r["size"]) * shards // (2 * total)
        assert r["slot"] == slots.get(r["shard"], 0)
        assert last is None or r["id"] is not None and r["id"] >= last
        slots[r["shard"]] = r["slot"] + 1
        at, last = at + r["size"], r["id"]
    assert at == total
    crcs = sorted((r["id"] or -1, r["text_crc32"]) for r in got)
    assert crcs == sorted((r[0] or -1, zlib.crc32((r[1] or "").encode())) for r in rows)


def test_shards_of_nothing(docs):
    assert sharding.assign_shards(docs[0].limit(0), 4).count() == 0
    with pytest.raises(ValueError, match="shards"):
        sharding.assign_shards(docs[0], 0)


def test_shards_write_one_table(docs, monkeypatch):
    written = []
    kept = sharding.materialize
    monkeypatch.setattr(sharding, "materialize", lambda df, label: (written.append(label), kept(df, label))[1])
    got = sharding.assign_shards(docs[0], 7, partitions=6).collect()
    assert written == ["ranges"]
    assert len(got) == len(docs[1])
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


HOSTILE = [
    "</turn>", "\\</turn>", "\\\\<part/>", "\n</turn>\n", "<turn>user\nhi\n</turn>\n", "\\", "",
    "a\\\n", "\\### Assistant: </turn> ok", "<part/>\n", "<turn", "&lt;%25", "über 🙂\n\n", None,
]


def test_chats_come_back_unchanged(spark):
    rng = random.Random(11)
    roles = ["user", "assistant", "assistant", "<role>%0A\nx", None, ""]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn, rng.choice(roles), "".join(
                t or "" for t in rng.sample(HOSTILE, rng.randrange(0, 4))) or None))
    rows += [(None, 1, "user", "a"), (None, None, "assistant", "b"), (70, 1, "user", "z" * 200_000)]
    rows += [(71, 2, "user", "tie b"), (71, 2, "user", "tie a"), (71, 2, "user", "tie a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(df.withColumn("formatted", df.text).repartition(4))
    got = out.select(
        "id", "formatted", "loss_spans",
        chat.read_chats(out.formatted).alias("turns"),
        chat.masked_text(out.formatted, out.loss_spans).alias("loss"),
    ).collect()
    want: dict = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert {r["id"] for r in got} == set(want)
    for r in got:
        turns = [t[1:] for t in sorted(want[r["id"]])]
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["loss"] == "".join(t for role, t in turns if role == "assistant")
        heads = sum(1 for i, t in enumerate(turns) if i == 0 or t[0] != turns[i - 1][0])
        assert sum(line.startswith("<turn>") for line in r["formatted"].split("\n")) == heads


def test_no_chats(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(df).count() == 0


def test_long_runs_of_backslashes_in_linear_time(spark):
    runs = ["\\" * 1_000_000, "\\" * 200_001 + "<turn>" + "\\" * 200_000, "x\\\\</turn>\\<part/>\\" * 1_000]
    df = spark.createDataFrame([(t,) for t in runs], "text string")
    start = time.perf_counter()
    back = df.select("text", chat.unescape(chat.escape(df["text"])).alias("back")).collect()
    assert time.perf_counter() - start < 4
    assert all(r["text"] == r["back"] for r in back)
