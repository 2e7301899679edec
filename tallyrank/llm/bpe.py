"""Byte-level BPE encoding with content-defined chunks that documents share.

Texts are cut where a rolling hash of the last bytes hits a pattern, so equal passages fall
into equal chunks wherever they stand. A first pass counts the chunks' hashes. Chunks that
occur more than once are then encoded once each, in a table of their own; what lies between
them is encoded where it is read. A document's tokens are put together from both, and every
joint is repaired: from the joint the window grows left and right to the nearest token edges
at which both sides and the whole text must agree, and its text is encoded again. Such an
edge is a single space between two printable ASCII characters: the tokenizer's splitting
pattern starts a word there whatever stands further away, and merges never cross words. So
the tokens are exactly those of encoding the whole text at once.

Which chunks are shared reaches the tasks as a Bloom filter with 16 to 32 bits for each of
them, ``FILTER_BYTES`` at most as it is broadcast. A false hit sends a chunk that occurs once
the way of the shared ones, with the same result: up to 33 million shared chunks less than three
of a thousand others, a quarter at 160 million. Documents without a shared chunk are never
shuffled.

Defined results: a null or empty text has no tokens and decodes to the empty text. Special
tokens written out in a text are encoded as the library does, even across chunk edges.
Texts of any length are encoded whole; repeated rows are rows of the result.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrank.llm.common import map_texts
from tallyrank.sources.scratch import gathered, materialize

MIN_CHUNK, MAX_CHUNK = 64, 4096
_MASK = 0xFF  # a cut every 256 bytes on average, beyond the smallest size
_ROLL = 8  # bytes that decide about a cut
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([i])) for i in range(256)], dtype=np.uint32)
FILTER_BYTES = 64 << 20
_FILTER_BITS = 16  # for each chunk, at least
_FILTER_HASHES = 4
_FLUSH = 200_000
# The splitting pattern of byte-level BPE, a fixed value.
_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")


def cut(raw: bytes) -> list[int]:
    """Ends of the chunks of a UTF-8 text, always between characters."""
    size = len(raw)
    if size <= MIN_CHUNK:
        return [size] if size else []
    b = np.frombuffer(raw, dtype=np.uint8)
    gear = _GEAR[b]
    rolled = gear.copy()
    for k in range(1, min(_ROLL, size)):
        rolled[k:] += gear[:-k] << np.uint32(k)
    hits = np.nonzero(((rolled[:-1] >> np.uint32(8)) & np.uint32(_MASK)) == 0)[0] + 1
    hits = hits[(b[hits] & 0xC0) != 0x80].tolist()
    ends, last = [], 0
    for hit in [*hits, size]:
        while hit - last > MAX_CHUNK:
            end = last + MAX_CHUNK
            while (b[end] & 0xC0) == 0x80:
                end -= 1
            ends.append(end)
            last = end
        if hit - last >= MIN_CHUNK or hit == size:
            ends.append(hit)
            last = hit
    return ends


def chunks(raw: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, 16-byte hash) of each chunk."""
    start = 0
    for end in cut(raw):
        yield start, end, xxhash.xxh3_128_digest(raw[start:end])
        start = end


def count_chunks(texts: DataFrame) -> DataFrame:
    """(hash, n) of the chunks that occur more than once; ``texts`` has the column text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                names=["hash", "n"],
            )
            counts.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    counts.update(h for _, _, h in chunks(text.as_buffer().to_pybytes()))
                if len(counts) > _FLUSH:
                    yield out()
        if counts:
            yield out()

    parts = texts.mapInArrow(run, "hash binary, n long")
    return parts.groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1")


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit numbers of each 16-byte hash (rows of two integers) in a filter of ``bits`` bits."""
    k = np.arange(_FILTER_HASHES, dtype=np.uint64)
    return (hashes[:, :1] + k * hashes[:, 1:]) & np.uint64(bits - 1)


def filter_bytes(chunks: int) -> int:
    """The filter's size for so many chunks, a power of two."""
    return min(FILTER_BYTES, 1 << max(6, (chunks * _FILTER_BITS // 8).bit_length()))


def build_filter(hashes: DataFrame, size: int | None = None) -> np.ndarray:
    """Bloom filter of ``size`` bytes (a power of two) over the column hash.

    Without a size it follows the number of hashes. It is put together from the 64-bit words
    that tasks set, each sent once.
    """
    bits = (size or filter_bytes(hashes.count())) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 64, dtype=np.uint64)
        for batch in batches:
            raw = b"".join(batch.column(0).to_pylist())
            at = _places(np.frombuffer(raw, dtype="<u8").reshape(-1, 2), bits).ravel()
            np.bitwise_or.at(own, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        words = np.nonzero(own)[0]
        for i in range(0, len(words), 100_000):
            part = words[i : i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int64)), pa.array(own[part].view(np.int64))],
                names=["word", "bits"],
            )

    rows = hashes.select("hash").mapInArrow(run, "word long, bits long")
    rows = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(bits // 64, dtype=np.int64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return words.view(np.uint64)


def in_filter(words: np.ndarray, hashes: list[bytes]) -> np.ndarray:
    if not hashes:
        return np.zeros(0, dtype=bool)
    at = _places(np.frombuffer(b"".join(hashes), dtype="<u8").reshape(-1, 2), len(words) * 64)
    set_bits = words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))
    return (set_bits & np.uint64(1)).all(axis=1)


def _byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    alphabet = {chr(b): b for b in same}
    others = (b for b in range(256) if b not in set(same))
    return alphabet | {chr(256 + n): b for n, b in enumerate(others)}


def _plain_byte_bpe(spec: str) -> bool:
    """Is it byte-level BPE with the usual pattern, nothing before it, and ids by merge?"""
    given = json.loads(spec)
    split, model = given.get("pre_tokenizer") or {}, given["model"]
    vocabulary = model.get("vocab", {})
    merged = ["".join(m.split(" ", 1) if isinstance(m, str) else m) for m in model.get("merges", [])]
    ids = [vocabulary.get(m, -1) for m in merged]
    return (
        given.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        and not model.get("ignore_merges")
        and all(a < b for a, b in zip(ids, ids[1:]))
        and len(set(merged)) + 256 == len(vocabulary)
        and not any(
            t[flag]
            for t in given.get("added_tokens", [])
            for flag in ("single_word", "lstrip", "rstrip", "normalized")
        )
    )


class Codec:
    """The tokenizer with the bytes of every token, for repairs.

    Where ids follow the order of the merges, ``tiktoken`` finds the same tokens about three
    times as fast: a token is only ever made by its own merge, since the parts it is made of
    come first. It is used for texts of Latin letters, whose character classes no version of
    Unicode changes; ``tokenizers`` itself encodes all others.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        added = self.tokenizer.get_added_tokens_decoder()
        byte_of = _byte_alphabet()
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            plain = token.encode() if i in added else bytes(byte_of[c] for c in token)
            self.bytes_of[i] = plain
        printable = range(0x21, 0x7F)
        self.starts = np.array(
            [len(t) > 1 and t[0] == 0x20 and t[1] in printable for t in self.bytes_of], dtype=bool
        )
        self.ends = np.array([bool(t) and t[-1] in printable for t in self.bytes_of], dtype=bool)
        self.sizes = np.array([len(t) for t in self.bytes_of], dtype=np.int64)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        #: How token parts travel between the stages.
        self.packed = "<u2" if len(self.bytes_of) <= 1 << 16 else "<u4"
        self.fast = None
        if _plain_byte_bpe(spec):
            import tiktoken

            self.fast = tiktoken.Encoding(
                "same-merges",
                pat_str=_PATTERN,
                mergeable_ranks={t: i for i, t in enumerate(self.bytes_of) if i not in added},
                special_tokens={t.content: i for i, t in added.items()},
            )

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        return [self._encode(t.decode("utf-8", "replace")) for t in texts]

    def _encode(self, text: str) -> np.ndarray:
        if self.fast is not None and not _BEYOND_LATIN.search(text):
            return np.asarray(self.fast.encode_to_numpy(text, allowed_special="all"), dtype="<u4")
        (encoded,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(encoded.ids, dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The library's text of ``ids``: their bytes in a row, read as UTF-8."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return ""
        at = np.repeat(self.firsts[ids] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.all_bytes[at].tobytes().decode("utf-8", "replace")

    def join(self, parts: list[np.ndarray]) -> np.ndarray:
        """The tokens of the whole text from those of its consecutive parts."""
        parts = [p for p in parts if len(p)]
        if len(parts) < 2:
            return parts[0] if parts else np.zeros(0, dtype="<u4")
        ids = np.concatenate(parts)
        joints = np.cumsum([len(p) for p in parts])[:-1].tolist()
        # Before which tokens all encodings of the text around have an edge.
        agreed = np.zeros(len(ids) + 1, dtype=bool)
        agreed[1:-1] = self.starts[ids[1:]] & self.ends[ids[:-1]]
        agreed[0] = agreed[-1] = True
        edges = np.nonzero(agreed)[0]
        out, done = [], 0
        for joint in joints:
            if joint < done:
                continue  # the window before reached over it
            left = int(edges[np.searchsorted(edges, joint, "right") - 1])
            right = int(edges[np.searchsorted(edges, joint, "left")])
            left = max(left, done)
            out.append(ids[done:left])
            if left < right:
                text = b"".join(self.bytes_of[i] for i in ids[left:right].tolist())
                out.append(self.encode([text])[0])
            done = right
        out.append(ids[done:])
        return np.concatenate(out)


_codecs: dict[str, Codec] = {}


def codec_of(spec: str) -> Codec:
    """One codec for all tasks of a worker process."""
    if spec not in _codecs:
        _codecs.clear()
        _codecs[spec] = Codec(spec)
    return _codecs[spec]


_CODED = [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]


def _stretches(raw: bytes, words: np.ndarray) -> list[tuple[int, int, bytes | None]]:
    """The text as shared chunks (with their hash) and what lies between (None)."""
    cuts = list(chunks(raw))
    shared = in_filter(words, [h for _, _, h in cuts])
    found: list[tuple[int, int, bytes | None]] = []
    for (start, end, h), hit in zip(cuts, shared.tolist()):
        if hit:
            found.append((start, end, h))
        elif found and found[-1][2] is None:
            found[-1] = (found[-1][0], end, None)
        else:
            found.append((start, end, None))
    return found


def _split_documents(docs: DataFrame, text_col: str, keep: list[str], words, spec) -> DataFrame:
    """Per document with shared chunks: its parts, each with tokens or a chunk's hash.

    Also rows with ``hash`` and ``chunk`` for every shared chunk a task meets.
    """
    part = T.StructType(
        [T.StructField("ids", T.BinaryType()), T.StructField("hash", T.BinaryType())]
    )
    fields = [
        T.StructField("parts", T.ArrayType(part)),
        T.StructField(
            "new",
            T.ArrayType(
                T.StructType(
                    [T.StructField("hash", T.BinaryType()), T.StructField("chunk", T.BinaryType())]
                )
            ),
        ),
    ]

    def make():
        codec, sent = codec_of(spec.value), set()

        def one(raw):
            found = _stretches(raw or b"", words.value)
            if not any(h for _, _, h in found):
                return None, None
            own = iter(codec.encode([raw[a:b] for a, b, h in found if h is None]))
            new = []
            for a, b, h in found:
                if h is not None and h not in sent:
                    sent.add(h)
                    new.append({"hash": h, "chunk": raw[a:b]})
            if len(sent) > _FLUSH:
                sent.clear()
            return [
                {"ids": None if h else next(own).astype(codec.packed).tobytes(), "hash": h}
                for _, _, h in found
            ], new

        return one

    return map_texts(docs, text_col, make, fields, keep).where("parts is not null")


def encode(
    docs: DataFrame, spec: str, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (default: all), ``ids`` and ``decoded``.

    ``spec`` is the tokenizer's JSON. ``ids`` are little-endian unsigned 32-bit integers, the
    usual form of token files; ``decoded`` is their text, special tokens included. Columns
    of ``docs`` with these names are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("ids", "decoded")
    keep = [c for c in keep or docs.columns if c not in ("ids", "decoded")]
    shared = count_chunks(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")))
    spec_ = spark.sparkContext.broadcast(spec)
    shared = materialize(gathered(shared.select("hash")), "shared")
    words = spark.sparkContext.broadcast(build_filter(shared))

    def whole():
        codec = codec_of(spec_.value)

        def one(raw):
            raw = raw or b""
            if any(h for _, _, h in _stretches(raw, words.value)):
                return None, None  # comes from its parts below
            ids = codec.encode([raw])[0]
            return ids.tobytes(), codec.decode(ids)

        return one

    alone = map_texts(docs, text_col, whole, _CODED, keep).where("ids is not null")
    names = [f"c{i}" for i in range(len(keep))]
    renamed = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)],
        F.col(f"`{text_col}`").alias("text"),
    )
    split = _split_documents(renamed, "text", names, words, spec_)
    split = materialize(split.withColumn("row_id", F.monotonically_increasing_id()), "parts")
    return alone.unionByName(_put_together(split, names, spec_).toDF(*keep, "ids", "decoded"))


def _put_together(split: DataFrame, names: list[str], spec) -> DataFrame:
    def encoder():
        codec = codec_of(spec.value)
        return lambda chunk: (codec.encode([chunk])[0].astype(codec.packed).tobytes(),)

    once = split.select(F.inline("new")).groupBy("hash").agg(F.first("chunk").alias("chunk"))
    table = map_texts(gathered(once), "chunk", encoder, [T.StructField("tokens", T.BinaryType())], ["hash"])
    table = materialize(table, "encoded-chunks")
    holes = split.select("row_id", F.posexplode("parts").alias("at", "part")).where(
        "part.hash is not null"
    )
    # Adaptive execution splits a chunk that very many documents share.
    filled = (
        holes.select("row_id", "at", F.col("part.hash").alias("hash"))
        .join(table, "hash")
        .groupBy("row_id")
        .agg(F.sort_array(F.collect_list(F.struct("at", "tokens"))).alias("filled"))
    )
    whole = split.drop("new").join(filled, "row_id").drop("row_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(spec.value)
        n = len(names)
        for batch in batches:
            # A document's parts and tokens are a few times its text.
            for start in range(0, batch.num_rows, 500):
                piece = batch.slice(start, 500)
                ids, decoded = [], []
                for parts, fills in zip(piece.column(n), piece.column(n + 1)):
                    tokens = {f["at"]: f["tokens"] for f in fills.as_py()}
                    raw = [
                        p["ids"] if p["hash"] is None else tokens[i]
                        for i, p in enumerate(parts.as_py())
                    ]
                    joined = codec.join(
                        [np.frombuffer(r, dtype=codec.packed).astype("<u4") for r in raw]
                    )
                    ids.append(joined.tobytes())
                    decoded.append(codec.decode(joined))
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[:n], pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                    names=[*piece.schema.names[:n], "ids", "decoded"],
                )
        pa.default_memory_pool().release_unused()

    schema = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in split.schema.fields if f.name in names]
        + _CODED
    )
    return whole.select(*names, "parts", "filled").mapInArrow(run, schema)
