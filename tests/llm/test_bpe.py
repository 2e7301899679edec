"""BPE: shared chunks and repaired joints give the library's own tokens."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tallyrank.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

PIECES = [
    "word", " word", "  two", "\n", "\n\n", " \n ", "\t", "'s", "'ll", "don't", " 123", "4567", "!!", " ?!",
    "É", " été", "\u00a0", "\u3000", "汉字", " 漢", "🙂", "<|endoftext|>", "<|endo", "ftext|>", "a" * 50, "%%%", " x ",
    "e\u0301", "\u200d", "\r\n", "_", "__init__", " the", "The",
]


@pytest.fixture(scope="module")
def spec():
    with open(public.path("byte_bpe_50k.json")) as f:
        return f.read()


@pytest.fixture(scope="module")
def library(spec):
    return tokenizers.Tokenizer.from_str(spec)


def _texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randrange(1, 60))) for _ in range(n)]


def test_joining_random_parts_is_exact(spec, library):
    codec, rng = bpe.Codec(spec), random.Random(4)
    for text in _texts(400):
        at = sorted(rng.sample(range(len(text) + 1), min(len(text), rng.randrange(1, 8))))
        parts = [text[a:b].encode() for a, b in zip([0, *at], [*at, len(text)])]
        joined = codec.join(codec.encode(parts))
        assert joined.tolist() == library.encode(text, add_special_tokens=False).ids


def test_chunks_cover_texts_and_stand_between_characters():
    for text in [*_texts(50), "", "é" * 20_000, "x" * 20_000, "ab " * 5_000]:
        raw = text.encode()
        ends = bpe.cut(raw)
        assert b"".join(raw[a:b] for a, b in zip([0, *ends], ends)) == raw
        assert all(raw[:e].decode() is not None for e in ends)
        assert all(b - a <= bpe.MAX_CHUNK for a, b in zip([0, *ends], ends))
    long = "".join(_texts(40)).encode()
    shared = set(h for _, _, h in bpe.chunks(long)) & set(h for _, _, h in bpe.chunks(b"prefix " + long))
    assert len(shared) > 3  # cuts follow the content


def test_filter_knows_its_members(spark):
    rng = random.Random(8)
    hashes = [rng.randbytes(16) for _ in range(2_000)]
    df = spark.createDataFrame([(bytearray(h),) for h in hashes[:1_000]], "hash binary").repartition(3)
    for size in (bpe.FILTER_BYTES, 256):
        words = bpe.build_filter(df, size)
        assert words.nbytes == size
        assert bpe.in_filter(words, hashes[:1_000]).all()
    assert bpe.in_filter(bpe.build_filter(df), hashes[1_000:]).mean() < 0.05


def test_filter_follows_the_number_of_chunks():
    assert [bpe.filter_bytes(n) for n in (0, 1, 1_000, 1_000_000)] == [64, 64, 2_048, 1 << 21]
    for n in (10, 12_345, 33_000_000):
        assert 16 * n <= 8 * bpe.filter_bytes(n) <= max(512, 32 * n + 8)
    assert bpe.filter_bytes(10**12) == bpe.FILTER_BYTES


@pytest.mark.parametrize("size", [bpe.FILTER_BYTES, 128])
def test_encoding_equals_the_library(spark, spec, library, size, monkeypatch):
    monkeypatch.setattr(bpe.build_filter, "__defaults__", (size,))
    passage = "".join(_texts(30, seed=3))
    texts = [*_texts(60, seed=2), None, "", "short", "short", passage * 40]
    texts += [f"{t or ''}{passage}{t or ''}" for t in texts[:25]] + [passage, passage]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, passage, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, parts int").repartition(4)
    out = bpe.encode(docs, spec)
    assert out.columns == ["doc_id", "text", "parts", "ids", "decoded"]
    got = out.collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    for r in got:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(docs.limit(0), spec).count() == 0
