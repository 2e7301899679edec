"""Decontamination against a look at every window."""

from __future__ import annotations

import random
import re
import string

import pytest

from tallyrank.llm import decontaminate as dec

_LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return _WORDS.findall((text or "").translate(_LOW))


def _plain(docs, items, window):
    windows: dict = {}
    for name, text in items:
        words = _words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add("" if name is None else str(name))
    out = []
    for doc, text, *_ in docs:
        words, hit, names = _words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if found := windows.get(tuple(words[i : i + size])):
                    names |= found
                    hit.update(range(i, i + size))
        out.append((doc, len(words), len(hit), sorted(names)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(2)

    def text(n, letters="abc"):
        return " ".join(rng.choices(letters, k=n))

    items = [(i, text(rng.randrange(0, 9))) for i in range(25)] + [
        (30, None), (31, "  ,. "), (None, "x y z w v"), (32, "Q, q. Q q q"), (32, "u u u"), (33, "ä Ö ü"),
        (34, text(40, "abcdefgh")),
    ]
    docs = [(i, text(rng.randrange(0, 60), "abcd"), "s") for i in range(120)] + [
        (200, None, "s"), (201, "", "s"), (202, "!!", None), (203, items[-1][1].upper() + " tail", "s"),
        (204, "a-b_c " * 30_000, "s"), (205, "ä Ö ü ä Ö", "s"), (206, "qq X, y; Z w V!", "s"),
        (206, "qq X, y; Z w V!", "s"),
    ]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, items string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string").repartition(2),
        docs,
        items,
    )


@pytest.mark.parametrize("window", [3, 5])
@pytest.mark.parametrize("block_words", [100_000, 40])
def test_hits_equal_windows(tables, window, block_words):
    docs, items, plain_docs, plain_items = tables
    found = dec.find_items(docs, items, window=window, block_words=block_words)
    assert found.columns == ["doc_id", "text", "n_words", "stretches", "items"]
    got = [
        (r["doc_id"], r["n_words"], sum(s["after"] - s["first"] for s in r["stretches"]), list(r["items"]))
        for r in found.collect()
    ]
    assert sorted(got, key=str) == _plain(plain_docs, plain_items, window)


def test_one_block_is_held_at_a_time(tables, monkeypatch):
    docs, items, *_ = tables
    share, held, most = dec._share_block, set(), []

    def spy(pieces, block):
        shared = share(pieces, block)
        destroy = shared.destroy
        held.add(block)
        most.append(len(held))
        shared.destroy = lambda: (held.discard(block), destroy())
        return shared

    monkeypatch.setattr(dec, "_share_block", spy)
    whole = dec.find_items(docs, items, window=5).drop("text").collect()
    held.clear()
    most.clear()
    parts = dec.find_items(docs, items, window=5, block_words=40).drop("text").collect()
    assert len(most) > 1 and max(most) == 1 and not held
    assert sorted(map(str, parts)) == sorted(map(str, whole))


def test_long_items_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(dec, "PIECE_WORDS", 12)
    words = [f"w{i}" for i in range(100)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    pieces = [r["words"] for r in dec._item_pieces(items, "text", "item_id", 10).collect()]
    windows = {tuple(p[i : i + 10]) for p in pieces for i in range(len(p) - 9)}
    assert len(windows) == 91


@pytest.mark.parametrize("block_words", [100_000, 40])
def test_cutting_leaves_clean_texts_alone(tables, block_words):
    docs, items, plain_docs, plain_items = tables
    docs = docs.withColumn("n_chars", docs.doc_id.cast("int"))
    kept = dec.remove_contamination(docs, items, window=5, max_share=0.5, chars_col="n_chars", block_words=block_words)
    assert kept.columns == docs.columns
    want = {d: (n, hit) for d, n, hit, _ in _plain(plain_docs, plain_items, 5)}
    texts = {d[0]: d[1] for d in plain_docs}
    got = kept.collect()
    assert {r["doc_id"] for r in got} == {d for d, (n, hit) in want.items() if hit <= n * 0.5}
    for r in got:
        n, hit = want[r["doc_id"]]
        if hit == 0:
            assert (r["text"], r["n_chars"]) == (texts[r["doc_id"]], r["doc_id"])
        else:
            assert len(_words(r["text"])) == n - hit
            assert r["n_chars"] == len(r["text"])


def test_empty_tables(tables):
    docs, items, *_ = tables
    assert dec.find_items(docs.limit(0), items).count() == 0
    assert dec.find_items(docs, items.limit(0)).where("size(items) > 0").count() == 0
