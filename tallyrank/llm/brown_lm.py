"""Class-based bigram language model after Brown: classes by exchange clustering.

A word's probability is that of its class after the class before it, times that of the word
in its class. Every word of the training texts has a class that exchange has found. Passes
over the texts, each summed inside tasks before anything is shuffled, gather the counts:

* word counts of the whole vocabulary, a table that grows with the texts;
* bigram counts over the ``CLUSTERED`` most frequent words, each rarer word standing for a
  hash of its ending. The exchange algorithm moves one word at a time to the class where the
  likelihood of these counts is highest, until few words move;
* for each rarer word, how often it stands before and after each class, a table that grows
  with the vocabulary. Each of these words goes to the class where the same likelihood is
  highest, the more frequent ones first: band by band, the sums of the classes are broadcast
  and tasks place the words of the band, whose counts then join the sums;
* bigrams of classes. Words beyond the ``HEAD`` most frequent, which every task knows (a bound
  on what is broadcast), get their classes by joining the vocabulary table.

Only words that no training text holds have a hashed class, that of their ending. The words
seen once stand for them: their bigrams are those of the hashed class of their ending too.
Their share of a hashed class is divided among as many unseen words as Chao's estimate (from
the words of that ending seen once and twice) says there are, so a random word costs more than
a rare one that is known. Transitions are smoothed by Witten-Bell towards the class frequencies.
A text's probabilities sum to one over the vocabulary and the estimated unseen words.

When texts are scored, the rarer words of a text meet the vocabulary table in a join, and the
transitions beside them are added once their classes are known.

Defined results: a null or empty text is one end token. Texts may repeat and null identifiers
train. With no training text every token has probability one in the base model, and the
class model knows hashed classes only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrank.llm.common import flat_bytes, pieces
from tallyrank.sources.scratch import materialize

CLUSTERED = 1_000
CLASSES = 64
TAIL_CLASSES = 16
HEAD = 200_000
HEAD_WORD_BYTES = 64
ROUNDS = 8
END = b" "  # no word holds a space
_FLUSH = 400_000  # words a task counts before it sends them on
_FLUSH_PAIRS = 2_000_000  # and neighbours
_SLICE = 100_000  # rows a task sends at once
_RUN = 4 << 20  # bytes of texts whose tokens a task looks up at once, more if one text has more
# Bytes in lower case, white space as a space.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[9:14] = 32


def tokens(text: bytes | None) -> list[bytes]:
    """Words after lower-casing A to Z, and the end."""
    words = (text or b"").lower().split()
    words.append(END)
    return words


def token_array(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``tokens`` of all texts one after another, as binary, and how many each text has."""
    none, space = (pa.scalar(c, texts.type) for c in ("", " "))
    data, bounds = flat_bytes(pc.binary_join_element_wise(pc.fill_null(texts, none), none, space))
    data, ends = _LOWER[data], bounds[1:] - 1
    blank = data == 32
    kept = ~blank
    kept[ends] = True  # the space added to a text is its end
    starts = kept.copy()
    starts[1:] &= blank[:-1]
    starts[ends] = True
    n = np.diff(np.cumsum(starts)[ends], prepend=0)
    at = np.append(np.flatnonzero(starts[kept]), np.count_nonzero(kept)).astype(np.int32)
    buffers = [None, pa.py_buffer(at), pa.py_buffer(data[kept])]
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, buffers), n


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
    """Tokens of whole texts one after the other: as a text follows an end, the first of a run
    may be taken to follow the last."""
    for batch in batches:
        for piece in pieces(batch, 0, _RUN):
            yield token_array(piece.column(0))[0]


class _Numbers:
    """Looks up tokens: the number of each, -1 without one."""

    def __init__(self, known: dict[bytes, int]):
        self.words = pa.array(list(known), pa.binary())
        self.numbers = np.append(np.array(list(known.values()), dtype=np.int64), -1)

    def of(self, words: pa.Array) -> np.ndarray:
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1)
        return self.numbers[at.to_numpy(zero_copy_only=False)]


def _numbered(words: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """The different words, as strings, and the number of each word among them."""
    coded = pc.dictionary_encode(pa.concat_arrays(words))
    return coded.dictionary.cast(pa.string()), coded.indices.to_numpy().astype(np.int64)


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL_CLASSES


@cache
def _endings() -> tuple[np.ndarray, np.ndarray]:
    """Hashed classes of all endings of one byte and of two."""
    ones = [tail_class(bytes([b])) for b in range(256)]
    twos = [tail_class(bytes([a, b])) for a in range(256) for b in range(256)]
    return np.array(ones, dtype=np.int64), np.array(twos, dtype=np.int64)


def tail_classes(words: pa.Array) -> np.ndarray:
    """``tail_class`` of each word; none is empty."""
    data, bounds = flat_bytes(words)
    if not len(words):
        return np.zeros(0, dtype=np.int64)
    ones, twos = _endings()
    last = data[bounds[1:] - 1].astype(np.int64)
    before = data[np.maximum(bounds[1:] - 2, 0)].astype(np.int64)
    return np.where(np.diff(bounds) > 1, twos[before * 256 + last], ones[last])


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) of all tokens; ``texts`` has the one column text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0

        def merged() -> pa.Table:
            sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            return sums.select(["word", "n_sum"]).rename_columns(["word", "n"])

        def out() -> Iterator[pa.RecordBatch]:
            table = held[0] if len(held) == 1 else merged()
            table = table.set_column(0, "word", table["word"].cast(pa.string()))
            yield from table.to_batches(max_chunksize=_SLICE)
            held.clear()

        for words in _runs(batches):
            found = words.value_counts()
            held.append(pa.table([found.field(0), found.field(1)], names=["word", "n"]))
            rows += len(found)
            if rows > 2 * _FLUSH:
                held[:] = [merged()]
                rows = held[0].num_rows
                if rows > _FLUSH:
                    yield from out()
                    rows = 0
        if held:
            yield from out()

    parts = texts.mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def head_of(vocabulary: DataFrame, limit: int = HEAD) -> list[tuple[bytes, int]]:
    """The most frequent words, ``limit`` at most, by falling count."""
    short = vocabulary.where(F.octet_length("word") <= HEAD_WORD_BYTES)
    size = F.floor(F.log2("n") * 64).alias("size")
    sizes = short.groupBy(size).agg(F.count(F.lit(1)).alias("words")).collect()  # 64 * 63 at most
    least, total = None, 0
    for row in sorted(sizes, key=lambda r: -r["size"]):
        total += row["words"]
        if total > limit:
            break
        least = row["size"]
    if least is None:
        return []
    rows = short.where(F.floor(F.log2("n") * 64) >= least).select("word", "n").collect()
    return sorted(((r["word"].encode(), r["n"]) for r in rows), key=lambda x: (-x[1], x[0]))


def count_bigrams(texts: DataFrame, unit_of, units: int) -> DataFrame:
    """(a, b, n) over units: ``unit_of`` (broadcast) numbers the clustered words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Numbers(unit_of.value)
        clustered = units - TAIL_CLASSES
        counts = np.zeros(units * units, dtype=np.int64)
        for words in _runs(batches):
            after = known.of(words)
            rare = np.nonzero(after < 0)[0]
            after[rare] = clustered + tail_classes(words.take(pa.array(rare)))
            counts += np.bincount(np.roll(after, 1) * units + after, minlength=len(counts))
        seen = np.nonzero(counts)[0]
        for at in range(0, len(seen), 100_000):
            part = seen[at : at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((part // units).astype(np.int32)),
                    pa.array((part % units).astype(np.int32)),
                    pa.array(counts[part]),
                ],
                names=["a", "b", "n"],
            )

    parts = texts.mapInArrow(run, "a int, b int, n long")
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n"))


def exchange(counts: np.ndarray, clustered: int, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each unit. Units from ``clustered`` on are classes of their own and stay.

    Classes start from the ranks of the words in turn; the end keeps a class to itself.
    """
    units = len(counts)
    of = np.empty(units, dtype=np.int64)
    of[:clustered] = np.arange(clustered) % classes
    of[clustered:] = classes + np.arange(units - clustered)
    total = classes + units - clustered
    member = np.zeros((units, total))
    member[np.arange(units), of] = 1.0
    right = counts @ member  # unit to class of the next
    left = counts.T @ member  # unit to class of the one before
    pairs = member.T @ right
    out_sums, in_sums = counts.sum(axis=1), counts.sum(axis=0)

    def h(x):
        return x * np.log(np.maximum(x, 1e-300))

    for _ in range(rounds):
        moved = 0
        for w in range(clustered):
            old = of[w]
            both = counts[w, w]
            # Take the word out of its class.
            pairs[old] -= right[w]
            pairs[:, old] -= left[w]
            pairs[old, old] += both
            right_w, left_w = right[w].copy(), left[w].copy()
            right_w[old] -= both
            left_w[old] -= both
            rows, columns = pairs.sum(axis=1)[:classes], pairs.sum(axis=0)[:classes]
            free = pairs[:classes]
            into = pairs[:, :classes]
            gain = (h(free + right_w) - h(free)).sum(axis=1) + (h(into.T + left_w) - h(into.T)).sum(axis=1)
            c = np.arange(classes)
            corner = pairs[c, c]
            gain += h(corner + right_w[:classes] + left_w[:classes] + both) + h(corner)
            gain -= h(corner + right_w[:classes]) + h(corner + left_w[:classes])
            gain -= h(rows + out_sums[w]) - h(rows) + h(columns + in_sums[w]) - h(columns)
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            pairs[new] += right_w
            pairs[:, new] += left_w
            pairs[new, new] += both
            if new != old:
                moved += 1
                of[w] = new
                right[:, old] -= counts[:, w]
                right[:, new] += counts[:, w]
                left[:, old] -= counts[w]
                left[:, new] += counts[w]
        if moved <= clustered // 200:
            break
    return of


def _tallied(held: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The different numbers and how often each is there, in slices."""
    if held:
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        for at in range(0, len(keys), _SLICE):
            yield keys[at : at + _SLICE], n[at : at + _SLICE]


def _before(held: list[tuple]) -> np.ndarray:
    """Of the words of some runs, the first entries in ``held``, the place of the word before."""
    starts = np.cumsum([0] + [len(words) for words, *_ in held])
    return np.concatenate(
        [start + np.roll(np.arange(len(words)), 1) for start, (words, *_) in zip(starts, held)]
    )


def _merged(number, keys, counts, span: int):
    """Of ascending word numbers with keys and counts: each pair once, as number, key and count."""
    both = number * span + keys
    order = np.argsort(both, kind="stable")
    both = both[order]
    starts = np.nonzero(np.diff(both, prepend=-1))[0]
    both = both[starts]
    return both // span, both % span, np.add.reduceat(counts[order], starts)


_COUNT_BITS = 40  # of a packed neighbour; its key has the others


def _listed(words: pa.Array, number, keys, counts, classes: int) -> pa.RecordBatch:
    """One row of each word in ``words``, all of which have a number: its neighbours as 64-bit
    integers, key and count, one after another."""
    width = classes + TAIL_CLASSES
    starts = np.concatenate([np.nonzero(np.diff(number, prepend=-1))[0], [len(number)]])
    packed = (keys << _COUNT_BITS | counts).astype("<i8")
    # Each occurrence follows one word, which may be the same.
    first = np.where((keys < width) | (keys == 2 * width), counts, 0)
    bounds = [None, pa.py_buffer((starts * 8).astype(np.int32)), pa.py_buffer(packed)]
    return pa.RecordBatch.from_arrays(
        [
            words,
            pa.Array.from_buffers(pa.binary(), len(words), bounds),
            pa.array(np.add.reduceat(first, starts[:-1]).astype(np.int64)),
        ],
        names=["word", "packed", "n"],
    )


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many neighbours each row has; the keys and counts of all."""
    flat, bounds = flat_bytes(column)
    both = flat.view("<i8")
    return np.diff(bounds) // 8, both >> _COUNT_BITS, both & ((1 << _COUNT_BITS) - 1)


def count_contexts(texts: DataFrame, class_of, classes: int) -> DataFrame:
    """(word, packed, n) of all words without a class in ``class_of`` (broadcast).

    ``packed`` holds keys with counts (see ``_listed``). Key c stands for class c before the word, width + c for class c after it, 2 * width for the
    word itself after it. Words without a class count as their hashed one. ``n`` is the number of
    the word.

    Tasks send one row of a word for some millions of neighbours. The rows of a word meet in one
    task in order and are added one by one, so it holds 2 * width + 1 counts of it at most.
    """
    width = classes + TAIL_CLASSES
    span = 2 * width + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Numbers(class_of.value)
        held: list[tuple] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            words, number = _numbered([h[0] for h in held])
            left, right, beside = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
            before = _before(held)
            held.clear()
            same = beside & (number[before] == number)
            ahead = np.zeros(len(same), dtype=bool)  # the word after is the same
            ahead[before[same]] = True
            start = number * span
            left = start + np.where(same, 2 * width, left)
            both, n = np.unique(
                np.concatenate([left, (start + width + right)[~ahead]]), return_counts=True
            )
            number = both // span
            cuts = np.searchsorted(number, np.arange(0, len(words) + _SLICE, _SLICE))
            for i, (at, end) in enumerate(zip(cuts, cuts[1:])):
                if end > at:
                    part = words.slice(i * _SLICE, _SLICE)
                    yield _listed(part, number[at:end], both[at:end] % span, n[at:end], classes)

        for words in _runs(batches):
            here = known.of(words)
            rare = np.nonzero(here < 0)[0]
            if not len(rare):
                continue
            others = words.take(pa.array(rare))
            here[rare] = classes + tail_classes(others)
            # A text follows an end. ``beside``: the token before is a word without a class too.
            beside = (rare - 1) % len(here) == np.roll(rare, 1)
            held.append((others, here[rare - 1], here[(rare + 1) % len(here)], beside))
            size += 2 * len(rare)
            if size > _FLUSH_PAIRS:
                yield from out()
                size = 0
        if held:
            yield from out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None  # the last word so far, whose rows may go on, with its sums
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column("word").dictionary_encode()
            words, row = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
            size, keys, counts = _unpacked(batch.column("packed"))
            number = np.repeat(row, size)
            if last is not None and words[0].as_py() == last:
                number = np.concatenate([np.zeros(len(kept[0]), dtype=np.int64), number])
                keys, counts = np.concatenate([kept[0], keys]), np.concatenate([kept[1], counts])
            elif last is not None:
                yield _listed(pa.array([last]), np.zeros(len(kept[0]), dtype=np.int64), *kept, classes)
            number, keys, counts = _merged(number, keys, counts, span)
            final = np.searchsorted(number, len(words) - 1)
            last, kept = words[-1].as_py(), (keys[final:], counts[final:])
            if final:
                yield _listed(words[:-1], number[:final], keys[:final], counts[:final], classes)
        if last is not None:
            yield _listed(pa.array([last]), np.zeros(len(kept[0]), dtype=np.int64), *kept, classes)

    columns = "word string, packed binary, n long"
    parts = texts.mapInArrow(run, columns)
    return parts.repartition("word").sortWithinPartitions("word").mapInArrow(merge, columns)


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_classes(left, right, both, own, pairs, classes: int) -> np.ndarray:
    """The class in which each word raises the likelihood most, as in ``exchange``.

    ``left`` and ``right`` count the classes before and after a word (rows are words), ``both``
    the word after itself. The word still counts in ``pairs`` as its hashed class ``own``.
    """
    gain = np.zeros((len(own), classes))
    for counts, other, sums in ((right, left, pairs), (left, right, pairs.T)):
        row, column = np.nonzero(counts)
        if not len(row):
            continue
        sums = sums[:classes]
        n = counts[row, column]
        # Most neighbours stand beside a word once: what that adds is looked up.
        each = (_h(sums + 1) - _h(sums)).T[column]
        mine = column == own[row]
        odd = np.nonzero(mine | (n != 1))[0]
        base = sums.T[column[odd]]
        mine = mine[odd]
        base[mine] -= other[row[odd[mine]], :classes]  # the word is taken out of its class first
        each[odd] = _h(base + n[odd, None]) - _h(base)
        starts = np.nonzero(np.diff(row, prepend=-1))[0]
        gain[row[starts]] += np.add.reduceat(each, starts, axis=0)
    after, before, twice = right[:, :classes], left[:, :classes], both[:, None]
    near = after + before + twice
    row, column = np.nonzero(near)
    corner = np.diag(pairs)[column]
    gain[row, column] += _h(corner + near[row, column]) + _h(corner)
    gain[row, column] -= _h(corner + after[row, column]) + _h(corner + before[row, column])
    rows, columns = pairs.sum(axis=1)[:classes], pairs.sum(axis=0)[:classes]
    for sums, counts in ((rows, right), (columns, left)):
        total, place = np.unique(counts.sum(axis=1) + both, return_inverse=True)
        gain -= (_h(sums + total[:, None]) - _h(sums))[place]
    return gain.argmax(axis=1)


def _place(contexts: DataFrame, pairs: np.ndarray, classes: int) -> DataFrame:
    """``contexts`` with the best class of each word as ``tail``, its hashed one as ``hashed``."""
    width = classes + TAIL_CLASSES
    shared = contexts.sparkSession.sparkContext.broadcast(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                batch = whole.slice(at, 2_000)
                size, keys, counts = _unpacked(batch.column("packed"))
                row = np.repeat(np.arange(batch.num_rows), size)
                table = np.zeros((batch.num_rows, 2 * width + 1))
                table[row, keys] = counts
                hashed = np.array([tail_class(w.encode()) for w in batch.column("word").to_pylist()])
                best = best_classes(
                    table[:, :width], table[:, width:-1], table[:, -1], classes + hashed, sums, classes
                )
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(best.astype(np.int32)), pa.array(hashed.astype(np.int32))],
                    names=[*batch.schema.names, "tail", "hashed"],
                )

    return contexts.mapInArrow(run, "word string, packed binary, n long, tail int, hashed int")


def _moved(pairs: np.ndarray, placed: DataFrame, classes: int) -> np.ndarray:
    """``pairs`` after the placed words went from their hashed classes to their best ones."""
    width = classes + TAIL_CLASSES
    pairs = pairs.copy()
    span = 2 * width + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(classes * TAIL_CLASSES * span, dtype=np.int64)
        for batch in batches:
            size, keys, counts = _unpacked(batch.column("packed"))
            tail, hashed = (batch.column(c).to_numpy().astype(np.int64) for c in ("tail", "hashed"))
            np.add.at(sums, np.repeat((tail * TAIL_CLASSES + hashed) * span, size) + keys, counts)
        at = np.nonzero(sums)[0]
        group = at // span
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(x.astype(np.int32))
                for x in (group // TAIL_CLASSES, group % TAIL_CLASSES, at % span)
            ]
            + [pa.array(sums[at])],
            names=["tail", "hashed", "key", "n"],
        )

    parts = placed.select("packed", "tail", "hashed").mapInArrow(
        run, "tail int, hashed int, key int, n long"
    )
    sums = parts.groupBy("tail", "hashed", "key").agg(F.sum("n").alias("n"))
    for new, hashed, key, n in sums.collect():  # of classes, hashed classes and keys
        for c, sign in ((classes + hashed, -1), (new, 1)):
            if key == 2 * width:
                pairs[c, c] += sign * n
            elif key < width:
                pairs[key, c] += sign * n
            else:
                pairs[c, key - width] += sign * n
    return pairs


def place_all(contexts: DataFrame, pairs: np.ndarray, classes: int, bands: list[int]) -> DataFrame:
    """(word, n, tail, hashed) of all words in ``contexts``; ``bands`` are falling least counts."""
    contexts = materialize(contexts, "contexts")
    made, above = None, None
    for least in [*bands, 0]:
        band = contexts.where(F.col("n") >= least)
        if above is not None:
            band = band.where(F.col("n") < above)
        placed = _place(band, pairs, classes)
        if least:
            placed = materialize(placed, "placed")
            pairs = _moved(pairs, placed, classes)
        placed = placed.select("word", "n", "tail", "hashed")
        made, above = placed if made is None else made.unionByName(placed), least
    return made


def _code(unit: int, hashed: int, n: int) -> int:
    """Class of a word, and the hashed class it stands for in one that was seen once."""
    return unit * (TAIL_CLASSES + 1) + (hashed + 1 if n == 1 else 0)


def count_pairs(texts: DataFrame, code_of, vocabulary: DataFrame, classes: int) -> np.ndarray:
    """Bigrams of classes; ``code_of`` (broadcast) has the codes of the head words."""
    width = classes + TAIL_CLASSES
    codes = classes * (TAIL_CLASSES + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Numbers(code_of.value)
        dense = np.zeros(width * width, dtype=np.int64)
        held: list[tuple] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            names = ["left", "right", "code", "n"]
            words, number = _numbered([h[0] for h in held])
            left, right = (np.concatenate([h[i] for h in held]) for i in (1, 2))
            couples = (number[_before(held)] << 32 | number)[left < 0]
            held.clear()
            keys = number * 2 * codes
            for keys, n in _tallied([(keys + left)[left >= 0], (keys + codes + right)[right >= 0]]):
                met, side = words.take(pa.array(keys // (2 * codes))), keys // codes % 2
                none = pa.nulls(len(keys), pa.string())
                after = pa.array(side == 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pc.if_else(after, met, none),
                        pc.if_else(after, none, met),
                        pa.array((keys % codes).astype(np.int32)),
                        pa.array(n),
                    ],
                    names=names,
                )
            for keys, n in _tallied([couples]):
                columns = [words.take(pa.array(keys >> 32)), words.take(pa.array(keys & 0xFFFFFFFF))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.nulls(len(keys), pa.int32()), pa.array(n)], names=names
                )

        for words in _runs(batches):
            after = known.of(words)
            before = np.roll(after, 1)  # a text follows an end
            (a, once_a), (b, once_b) = (np.divmod(x, TAIL_CLASSES + 1) for x in (before, after))
            full = (before >= 0) & (after >= 0)
            for left, right, at in (
                (a, b, full),
                (a, classes - 1 + once_b, full & (once_b > 0)),
                (classes - 1 + once_a, b, full & (once_a > 0)),
                (classes - 1 + once_a, classes - 1 + once_b, full & (once_a > 0) & (once_b > 0)),
            ):
                dense += np.bincount((left * width + right)[at], minlength=len(dense))
            rare = np.nonzero(after < 0)[0]
            if not len(rare):
                continue
            held.append((words.take(pa.array(rare)), before[rare], np.roll(after, -1)[rare]))
            size += 2 * len(rare)
            if size > _FLUSH_PAIRS:
                yield from out()
                size = 0
        if held:
            yield from out()
        at = np.nonzero(dense)[0]
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(at), pa.string()),
                pa.nulls(len(at), pa.string()),
                pa.array(at.astype(np.int32)),
                pa.array(dense[at]),
            ],
            names=["left", "right", "code", "n"],
        )

    parts = texts.mapInArrow(run, "left string, right string, code int, n long")
    rows = materialize(parts.groupBy("left", "right", "code").agg(F.sum("n").alias("n")), "pairs")

    def units(unit: Column, hashed: Column, once: Column) -> Column:
        return F.when(once, F.array(unit, hashed + classes)).otherwise(F.array(unit))

    of = F.floor(F.col("code") / (TAIL_CLASSES + 1)).cast("int")
    seen = F.col("code") % (TAIL_CLASSES + 1)
    given = units(of, seen - 1, seen > 0)
    words = vocabulary.select("word", units(F.col("tail"), F.col("hashed"), F.col("n") == 1).alias("units"))
    left, right = F.col("left").isNotNull(), F.col("right").isNotNull()
    firsts, seconds = words.toDF("left", "a"), words.toDF("right", "b")
    met = (
        rows.where(~left & right).join(seconds, "right").select(given.alias("a"), "b", "n")
        .unionByName(rows.where(left & ~right).join(firsts, "left").select("a", given.alias("b"), "n"))
        .unionByName(rows.where(left & right).join(firsts, "left").join(seconds, "right").select("a", "b", "n"))
    )
    joined = met.select(F.explode("a").alias("a"), "b", "n").select("a", F.explode("b").alias("b"), "n")
    known_pairs = rows.where(~left & ~right).select(
        F.floor(F.col("code") / width).cast("int").alias("a"), (F.col("code") % width).alias("b"), "n"
    )
    pairs = np.zeros((width, width))
    for a, b, n in known_pairs.unionByName(joined).groupBy("a", "b").agg(F.sum("n")).collect():
        pairs[a, b] = n
    return pairs


def unseen_types(vocabulary: DataFrame) -> np.ndarray:
    """Chao's estimate of the number of words that no text holds, by hashed class, 1 at least."""
    once, twice = (F.count_if(F.col("n") == n) for n in (1, 2))
    unseen = np.ones(TAIL_CLASSES)
    for hashed, f1, f2 in vocabulary.groupBy("hashed").agg(once, twice).collect():
        unseen[hashed] = max(1.0, f1 * (f1 - 1) / (2 * (f2 + 1)))
    return unseen


class BrownModel:
    """What tasks need: head words, classes, logarithms of transitions and emissions.

    ``tail_scale`` is to be added to log10 of a word's count, ``tail_unseen`` is the logarithm of
    an unseen word, of which ``unseen`` has the number per hashed class; both have all classes
    from ``first_tail`` on, which is the first of all.
    """

    first_tail = 0

    def __init__(self, head, n_tokens, n_types, pairs, totals, classes, end_class, unseen):
        self.n_tokens, self.n_types = n_tokens, n_types
        self.denominator = n_tokens + n_types + 1
        self.hashed_from, self.end_class = classes, end_class
        total = len(pairs)
        sums = pairs.sum(axis=0)
        shares = (sums + 1.0) / (sums.sum() + total)
        kinds = np.maximum(1, (pairs > 0).sum(axis=1))
        after = pairs.sum(axis=1)
        self.transitions = np.log10(
            (pairs + kinds[:, None] * shares) / (after + kinds)[:, None]
        )
        self.tail_scale = np.zeros(total)
        self.tail_scale[:classes] = -np.log10(np.maximum(1.0, totals))
        self.tail_unseen = np.full(total, -np.inf)
        self.tail_unseen[classes:] = -np.log10(unseen)
        self.index = {word: i for i, (word, _, _) in enumerate(head)}
        n = np.array([c for _, c, _ in head], dtype=float)
        self.classes = np.array([c for _, _, c in head], dtype=np.int64)
        self.base = np.log10((n + 1) / self.denominator) if len(n) else n
        self.emissions = np.log10(n) + self.tail_scale[self.classes] if len(n) else n

    def score(self, texts: pa.Array, index: _Numbers) -> list[pa.Array]:
        """Of each text: n_tokens, known, base and score of the head words; counts of the others, and
        the transitions beside them: two numbers each, classes or -1 - place among the others.
        ``index`` looks up the head words."""
        words, n = token_array(texts)
        rows = len(n)
        at = index.of(words)
        text = np.repeat(np.arange(rows), n)
        is_head = at >= 0
        head = at[is_head]
        after = np.append(self.classes, 0)[at]
        rest = np.flatnonzero(~is_head)
        others, number = _numbered([words.take(pa.array(rest))])
        span = max(1, len(others))
        each, place, times = np.unique(
            text[rest] * span + number, return_inverse=True, return_counts=True
        )
        bounds = np.searchsorted(each, np.arange(rows + 1) * span)
        after[rest] = -1 - (place - bounds[text[rest]])
        before = np.roll(after, 1)
        before[np.cumsum(n) - n] = self.end_class
        known = (before >= 0) & (after >= 0)
        # Without any weight the sums are integers.
        base = np.bincount(text[is_head], self.base[head], rows)
        score = np.bincount(text[is_head], self.emissions[head], rows) + np.bincount(
            text[known], self.transitions[before[known], after[known]], rows
        )
        steps = np.stack([before[~known], after[~known]], axis=1).ravel().astype(np.int32)
        step_bounds = np.append(0, np.cumsum(2 * np.bincount(text[~known], minlength=rows)))
        unseen = (self.hashed_from + tail_classes(others))[each % span]

        def lists(ends: np.ndarray, values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)

        return [
            pa.array(n.astype(np.int64)),
            pa.array(np.bincount(text[is_head], minlength=rows).astype(np.int64)),
            pa.array(base.astype(np.float64)),
            pa.array(score.astype(np.float64)),
            lists(bounds, others.take(pa.array(each % span))),
            lists(bounds, pa.array(unseen.astype(np.int32))),
            lists(bounds, pa.array(times.astype(np.int64))),
            lists(step_bounds, pa.array(steps)),
        ]


def train(
    texts: DataFrame,
    clustered: int = CLUSTERED,
    classes: int = CLASSES,
    head_limit: int = HEAD,
    rounds: int = ROUNDS,
) -> tuple[BrownModel, DataFrame]:
    """The model and the vocabulary table: word, n, its class as ``tail``, its hashed class as
    ``hashed``; ``texts`` has the column text."""
    spark = texts.sparkSession
    counted = materialize(count_words(texts), "words")
    sums = counted.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).first()
    head = head_of(counted, head_limit)
    clustered = min(clustered, len(head))
    units = clustered + TAIL_CLASSES
    unit_of = spark.sparkContext.broadcast({w: i for i, (w, _) in enumerate(head[:clustered])})
    counts = np.zeros((units, units))
    for row in count_bigrams(texts, unit_of, units).collect():  # units squared at most
        counts[row["a"], row["b"]] = row["n"]
    classes = max(1, min(classes, clustered))
    unit_class = exchange(counts, clustered, classes, rounds)
    width = classes + TAIL_CLASSES
    member = np.zeros((units, width))
    member[np.arange(units), unit_class] = 1.0
    pairs = member.T @ counts @ member

    first = [
        (w.decode(), n, int(c), tail_class(w)) for (w, n), c in zip(head[:clustered], unit_class)
    ]
    class_of = spark.sparkContext.broadcast({w.encode(): c for w, _, c, _ in first})
    # Words up to eight times as many as before, up to the end of the head, and all others.
    bands, size = [], 8 * clustered
    while clustered and size < len(head):
        bands.append(head[size][1])
        size *= 8
    bands = sorted({n for n in bands if n > 1}, reverse=True)
    placed = place_all(count_contexts(texts, class_of, classes), pairs, classes, bands)
    schema = "word string, n long, tail int, hashed int"
    vocabulary = materialize(placed.unionByName(spark.createDataFrame(first, schema)), "vocabulary")

    totals = np.zeros(classes)
    for c, n in vocabulary.groupBy("tail").agg(F.sum("n")).collect():
        totals[c] = n
    known: list[tuple[bytes, int, int, int]] = []
    if head:
        # As many rows as the head has: it holds all short words of its least count.
        rows = vocabulary.where((F.octet_length("word") <= HEAD_WORD_BYTES) & (F.col("n") >= head[-1][1]))
        known = [(r["word"].encode(), r["n"], r["tail"], r["hashed"]) for r in rows.collect()]
    code_of = spark.sparkContext.broadcast({w: _code(c, k, n) for w, n, c, k in known})
    pairs = count_pairs(texts, code_of, vocabulary, classes)
    end = vocabulary.where(F.col("word") == END.decode()).first()
    end_class = end["tail"] if end else classes + tail_class(END)
    unseen = unseen_types(vocabulary)
    model = BrownModel(
        [x[:3] for x in known], sums["n"] or 0, sums["types"], pairs, totals, classes, end_class, unseen
    )
    return model, vocabulary


_LOCAL = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("known", T.LongType()),
    T.StructField("base", T.DoubleType()),
    T.StructField("local_score", T.DoubleType()),
    T.StructField("others", T.ArrayType(T.StringType())),
    T.StructField("unseen", T.ArrayType(T.IntegerType())),
    T.StructField("times", T.ArrayType(T.LongType())),
    T.StructField("steps", T.ArrayType(T.IntegerType())),
]


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, one list after another, and how many each row has."""
    n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), n.astype(np.int64)


def score(
    docs: DataFrame, model: BrownModel, vocabulary: DataFrame, text_col: str, id_col: str
) -> DataFrame:
    """id, n_tokens, n_known, base_score and score (both log10) of every whole text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # HEAD words and class matrices
    key = docs.schema[id_col]
    schema = T.StructType([T.StructField(key.name, key.dataType), *_LOCAL])

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        model, arrow = shared.value, to_arrow_schema(schema)
        index = _Numbers({word: i for i, word in enumerate(model.index)})
        for batch in batches:
            for piece in pieces(batch, 1, _RUN):
                columns = [piece.column(0), *model.score(piece.column(1), index)]
                columns = [c.cast(f.type) for c, f in zip(columns, arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        pa.default_memory_pool().release_unused()  # the worker serves other tasks afterwards

    texts = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("text_in"))
    local = texts.mapInArrow(here, schema)
    local = materialize(local.withColumn("row_id", F.monotonically_increasing_id()), "local")
    each = F.posexplode(F.arrays_zip("others", "unseen", "times"))
    words = local.select("row_id", each).select(
        "row_id", "pos", F.col("col.others").alias("word"), "col.unseen", "col.times"
    )

    scale, unseen = (F.array(*[F.lit(float(v)) for v in x]) for x in (model.tail_scale, model.tail_unseen))
    n = F.coalesce("n", F.lit(0))
    emission = F.when(n > 0, F.log10(n) + scale[F.col("tail")]).otherwise(unseen[F.col("unseen")])
    # Adaptive execution splits a word that many texts share.
    met = words.join(vocabulary.select("word", "n", "tail"), "word", "left").select(
        "row_id",
        "pos",
        F.coalesce("tail", "unseen").alias("unit"),
        F.when(n > 0, F.col("times")).otherwise(0).alias("known"),
        (F.col("times") * F.log10((n + 1) / F.lit(float(model.denominator)))).alias("base"),
        (F.col("times") * emission).alias("score"),
    )
    rest = met.groupBy("row_id").agg(
        F.sum("known").alias("more_known"),
        F.sum("base").alias("more_base"),
        F.sum("score").alias("more_score"),
        F.collect_list(F.struct("pos", "unit")).alias("found"),
    )
    zero = F.lit(0)
    added = local.join(rest, "row_id", "left").select(
        F.col(id_col).alias("id"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("local_score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
        "steps",
        F.col("found.pos").alias("pos"),
        F.col("found.unit").alias("unit"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transitions = shared.value.transitions
        for batch in batches:
            scores = batch.column("score").to_numpy(zero_copy_only=False).copy()
            (steps, n), (pos, n_pos), (unit, _) = (
                _lists(batch.column(c)) for c in ("steps", "pos", "unit")
            )
            starts = np.cumsum(n_pos) - n_pos
            classes = np.zeros(len(pos) + 1, dtype=np.int64)
            classes[np.repeat(starts, n_pos) + pos] = unit
            place = np.where(steps >= 0, len(pos), np.repeat(starts, n) - 1 - steps)
            ends = np.where(steps >= 0, steps, classes[place])
            text = np.repeat(np.arange(batch.num_rows), n // 2)
            scores += np.bincount(text, transitions[ends[::2], ends[1::2]], batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(scores)], names=batch.schema.names[:5]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return added.mapInArrow(run, f"id {kind}, n_tokens long, n_known long, base_score double, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that never train: CRC-32 of the identifier as text, modulo 7, is 2."""
    crc = F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8"))
    return F.coalesce(crc % 7 == 2, F.lit(False))
