"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' words go into one automaton that accepts every run of words of every item. A
document is streamed through it word by word; the automaton's state gives the longest run
that ends at each word. Where that run reaches ``window`` words, or is all of a shorter
item, its words are hit, and the items that hold the run are those of the state.

The items are dealt to blocks of at most about ``block_words`` words by hash, long items in
overlapping pieces first; so what a task holds is bounded by that parameter, however large
the benchmark. With one block a document is done in a single pass without any shuffle. With
more, each block is a pass over the documents, and what the blocks found meets by digest of
the text, not by row. The blocks lie in a written table; the driver holds one at a time, which
it lets go when the pass is written.

Defined results: null or wordless texts and items have no words and no hits. Items with an
equal identifier count as one item; a null identifier reads as the empty string. Documents
may repeat and be of any length. Empty tables give no hits or no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrank.llm.common import map_texts, row_hash, salted_lookup, unused_name
from tallyrank.sources.scratch import materialize

WINDOW = 10
BLOCK_WORDS = 100_000
PIECE_WORDS = 5_000

# In UTF-8, after lower-casing A to Z: letters, digits and everything beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class ItemAutomaton:
    """Suffix automaton over the words of many items.

    ``items`` are (identifier, words) pairs. A state's ``length`` is that of its longest
    run of words; its ``link`` is the state of the longest run that ends the same way but
    occurs elsewhere, too.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.codes: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        ends: dict[int, set[str]] = {}
        self.whole: dict[int, set[str]] = {}  # short items, at the state of all their words
        for name, words in items:
            state = 0
            for word in words:
                state = self._extend(state, self.codes.setdefault(word, len(self.codes)))
                if len(words) >= window:
                    ends.setdefault(state, set()).add(name)
            if 0 < len(words) < window:
                self.whole.setdefault(state, set()).add(name)
        self._spread_names(ends)
        self._link_short_items()

    def _new(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, parent: int, code: int, child: int) -> int:
        """A state for the runs of ``child`` that are one word longer than ``parent``'s."""
        copy = self._new(self.length[parent] + 1, dict(self.next[child]), self.link[child])
        self.link[child] = copy
        while parent != -1 and self.next[parent].get(code) == child:
            self.next[parent][code] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, state: int, code: int) -> int:
        there = self.next[state].get(code)
        if there is not None:  # an earlier item has this run
            exact = self.length[there] == self.length[state] + 1
            return there if exact else self._split(state, code, there)
        made = self._new(self.length[state] + 1, {}, 0)
        while state != -1 and code not in self.next[state]:
            self.next[state][code] = made
            state = self.link[state]
        if state != -1:
            there = self.next[state][code]
            exact = self.length[there] == self.length[state] + 1
            self.link[made] = there if exact else self._split(state, code, there)
        return made

    def _spread_names(self, ends: dict[int, set[str]]) -> None:
        """For states whose runs pass the window: the items that hold them."""
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            up = self.link[state]
            if state in ends and self.length[up] >= self.window:
                ends.setdefault(up, set()).update(ends[state])
        self.names = ends

    def _link_short_items(self) -> None:
        """For each state, itself or the nearest state up its links that is a short item."""
        self.short = [-1] * len(self.length)
        for state in sorted(range(1, len(self.length)), key=lambda s: self.length[s]):
            self.short[state] = state if state in self.whole else self.short[self.link[state]]

    def scan(self, words: Iterator[bytes]) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words; stretches (first word, word after) that are hit; the items."""
        moves, link, length, short = self.next, self.link, self.length, self.short
        code_of, window, any_short = self.codes.get, self.window, bool(self.whole)
        stretches: list[tuple[int, int]] = []
        names: set[str] = set()
        state = run = 0
        i = -1
        for i, word in enumerate(words):
            code = code_of(word)
            if code is None:
                state = run = 0
                continue
            to = moves[state].get(code)
            if to is None:
                while state and to is None:
                    state = link[state]
                    to = moves[state].get(code)
                if to is None:
                    run = 0
                    continue
                run = length[state]
            state = to
            run += 1
            first = i + 1
            if run >= window:
                first = i + 1 - run
                holder = state
                while length[link[holder]] >= window:
                    holder = link[holder]
                names |= self.names[holder]
            if any_short:
                item = short[state if run == length[state] else link[state]]
                while item > 0:
                    first = min(first, i + 1 - length[item])
                    names |= self.whole[item]
                    item = short[link[item]]
            if first <= i:
                while stretches and stretches[-1][1] >= first:
                    first = min(first, stretches.pop()[0])
                stretches.append((first, i + 1))
        return i + 1, stretches, names


def _words(text: bytes | None) -> Iterator[bytes]:
    return (m.group() for m in _WORD.finditer((text or b"").lower()))


def _merge(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for first, after in sorted(stretches):
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(after, merged[-1][1]))
        else:
            merged.append((first, after))
    return merged


_FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField(
        "stretches",
        T.ArrayType(
            T.StructType([T.StructField("first", T.LongType()), T.StructField("after", T.LongType())])
        ),
    ),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def _item_pieces(items: DataFrame, text_col: str, id_col: str, window: int) -> DataFrame:
    """(name, words): the items' words in pieces that share ``window - 1`` words."""

    def make():
        def pieces(text):
            words = list(_words(text))
            step = PIECE_WORDS - window + 1
            starts = range(0, max(1, len(words) - window + 1), step)
            return ([words[s : s + PIECE_WORDS] for s in starts] if words else [],)

        return pieces

    field = T.StructField("pieces", T.ArrayType(T.ArrayType(T.BinaryType())))
    named = items.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("name"),
        F.col(f"`{text_col}`").alias("text"),
    )
    return map_texts(named, "text", make, [field], ["name"]).select(
        "name", F.explode("pieces").alias("words")
    )


def _written_pieces(
    items: DataFrame, text_col: str, id_col: str, window: int, block_words: int
) -> tuple[DataFrame, int]:
    """The items' pieces, written in order of their blocks of about ``block_words`` words, and
    the number of blocks, 1 at least. Reading a block skips the files of the others."""
    pieces = materialize(_item_pieces(items, text_col, id_col, window), "items")
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    n = max(1, -(-total // block_words))
    if n == 1:
        return pieces.withColumn("block", F.lit(0)), 1
    placed = pieces.withColumn("block", F.pmod(F.xxhash64("name", "words"), F.lit(n)))
    ordered = placed.repartitionByRange("block").sortWithinPartitions("block")
    return materialize(ordered, "blocks"), n


def _share_block(pieces: DataFrame, block: int):
    """A broadcast of one block, which is all that the driver holds of the items."""
    rows = pieces.where(F.col("block") == block).collect()  # about block_words words
    named = [(r["name"], list(r["words"])) for r in rows]
    return pieces.sparkSession.sparkContext.broadcast(named)


def _make_scanner(block, window: int):
    def make():
        automaton = ItemAutomaton(block.value, window)

        def one(text):
            n, stretches, names = automaton.scan(_words(text))
            return n, [{"first": a, "after": b} for a, b in stretches], sorted(names)

        return one

    return make


def find_items(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_text_col: str = "text",
    item_id_col: str = "item_id",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with n_words, stretches (of hit words, merged) and items (sorted names).

    Columns of ``docs`` with these names are replaced.
    """
    docs = docs.drop(*[f.name for f in _FOUND])
    pieces, n_blocks = _written_pieces(items, item_text_col, item_id_col, window, block_words)
    if n_blocks == 1:
        scanner = _make_scanner(_share_block(pieces, 0), window)
        return map_texts(docs, text_col, scanner, _FOUND, docs.columns)
    return _find_in_blocks(docs, text_col, pieces, n_blocks, window)


def _find_in_blocks(
    docs: DataFrame, text_col: str, pieces: DataFrame, n_blocks: int, window: int
) -> DataFrame:
    key = unused_name(docs, "text_key")
    keyed = docs.withColumn(key, F.unhex(F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256)))
    found = None
    for block in range(n_blocks):
        shared = _share_block(pieces, block)
        hits = map_texts(keyed, text_col, _make_scanner(shared, window), _FOUND, [key])
        hits = hits.where(F.size("items") > 0).dropDuplicates([key])
        hits = materialize(hits, "hits")
        shared.destroy()  # its hits are written: no task reads the block again
        found = hits if found is None else found.unionByName(hits)
    # At most one row per block for each text.
    found = found.groupBy(key).agg(
        F.flatten(F.collect_list("stretches")).alias("stretches"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    joined = salted_lookup(keyed, found, [key], row_hash(docs), "left")

    def count():
        return lambda text: (sum(1 for _ in _words(text)),)

    counted = map_texts(
        joined, text_col, count, [_FOUND[0]], [*docs.columns, "stretches", "items"]
    )
    merge = F.udf(
        lambda xs: [{"first": a, "after": b} for a, b in _merge([tuple(x) for x in xs or []])],
        _FOUND[1].dataType,
        useArrow=True,
    )
    return counted.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        "n_words",
        merge("stretches").alias("stretches"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def n_hit(stretches: str = "stretches"):
    return F.aggregate(
        stretches, F.lit(0).cast("long"), lambda n, s: n + s["after"] - s["first"]
    )


def remove_contamination(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_text_col: str = "text",
    item_id_col: str = "item_id",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    max_words: int = 0,
    max_share: float = 0.5,
    chars_col: str | None = None,
) -> DataFrame:
    """``docs`` without the spans of words that occur in the items.

    A stretch of hit words longer than ``max_words`` is cut out of the text with the
    separators inside it. A document of whose words more than ``max_share`` would go is
    dropped. All others keep their text byte for byte. ``chars_col`` (if named) is counted
    anew where the text changed.
    """
    columns = docs.columns
    work = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    at = f"c{columns.index(text_col)}"
    pieces, n_blocks = _written_pieces(items, item_text_col, item_id_col, window, block_words)

    def judge(text: str | None, n_words: int, stretches) -> tuple[bool, str | None]:
        over = [(a, b) for a, b in stretches if b - a > max_words]
        keeps = sum(b - a for a, b in over) <= max_share * n_words
        return keeps, _cut(text, over) if keeps and over else None

    if n_blocks == 1:
        shared = _share_block(pieces, 0)

        def make():
            automaton = ItemAutomaton(shared.value, window)

            def one(raw):
                n, stretches, _ = automaton.scan(_words(raw))
                return judge(raw, n, stretches)

            return one

        judged = map_texts(work, at, make, _JUDGED, work.columns)
    else:
        found = _find_in_blocks(work, at, pieces, n_blocks, window)
        verdict = F.udf(
            lambda text, n, xs: judge(text and text.encode(), n, [tuple(x) for x in xs]),
            T.StructType(_JUDGED),
            useArrow=True,
        )
        judged = found.select(
            *work.columns, verdict(F.col(at), "n_words", "stretches").alias("v")
        ).select(*work.columns, "v.*")
    out = []
    for i, name in enumerate(columns):
        column = F.col(f"c{i}")
        if name == text_col:
            column = F.coalesce("changed", column)
        elif name == chars_col:
            counted = F.length("changed").cast(docs.schema[name].dataType)
            column = F.when(F.col("changed").isNotNull(), counted).otherwise(column)
        out.append(column.alias(name))
    return judged.where("keeps").select(*out)


_JUDGED = [T.StructField("keeps", T.BooleanType()), T.StructField("changed", T.StringType())]


def _cut(raw: bytes, stretches: list[tuple[int, int]]) -> str:
    places = [m.span() for m in _WORD.finditer(raw.lower())]
    kept, at = [], 0
    for first, after in stretches:
        kept.append(raw[at : places[first][0]])
        at = places[after - 1][1]
    kept.append(raw[at:])
    return b"".join(kept).decode()
