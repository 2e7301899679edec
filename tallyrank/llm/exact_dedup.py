"""Exact duplicates by a tree merge of sorted digest runs. DataFrame functions only.

Every row is reduced to the SHA-256 of its normalised text. The rows are dealt to
``fan_in ** depth`` leaves; each leaf sorts its digests and keeps one row per digest with
its best identifier and count, a *run*. In each of ``depth`` rounds the runs of ``fan_in``
neighbours are exchanged, sorted and merged, and again one row per digest survives. A
digest only counts as equal if byte length and a second hash agree as well, so identifiers
are verified at every level. The rows of a round are dealt by node *and* digest: a merge is
spread over all tasks, and a text that a third of all rows share is one row per leaf after
the first step. The result goes back down the same way: root to leaves, leaves to rows.

Defined results: a null text is the empty text. A null identifier loses against any other;
a group of only null identifiers keeps one row under a null ``keep_id``. Rows with the same
identifier and text are told apart by their other columns; of fully identical rows exactly
one stays. An empty table gives an empty result. Columns of any name may be present.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrank.llm.common import ascii_lower, row_hash, unused_name
from tallyrank.sources.scratch import gathered, materialize

FAN_IN = 8
DEPTH = 2

# What must agree for two texts to be equal.
GROUP = ["digest", "n_bytes", "check"]


def _normalised(text_col: str) -> Column:
    return ascii_lower(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


def _keyed(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """One narrow row per row: identifier, hash of the whole row, digest of the text."""
    text = _normalised(text_col)
    return docs.select(
        F.col(f"`{id_col}`").alias("id"),
        row_hash(docs).alias("row"),
        text.alias("text"),
    ).select(
        "id",
        "row",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.octet_length("text").alias("n_bytes"),
        F.xxhash64("text").alias("check"),
    )


def merge_tree(
    rows: DataFrame,
    group: list[str],
    best: Column,
    pick=F.min,
    fan_in: int = FAN_IN,
    depth: int = DEPTH,
) -> DataFrame:
    """Adds ``best`` (``pick`` of it over all equal rows) and ``n`` (their number) to each row.

    ``rows`` must give the same rows each time it is read, with a unique ``row_id``.
    """
    leaves = rows.withColumn(
        "node", F.pmod(F.xxhash64("row_id"), F.lit(fan_in**depth)).cast("int")
    )
    # Structs are aggregated by sorting, so each of these is a run in digest order.
    runs = leaves.groupBy("node", *group).agg(
        pick(best).alias("best"), F.count(F.lit(1)).alias("n")
    )
    merged = runs
    for _ in range(depth):
        merged = (
            merged.withColumn("node", F.floor(F.col("node") / fan_in).cast("int"))
            .groupBy("node", *group)
            .agg(pick("best").alias("best"), F.sum("n").alias("n"))
        )
    down = runs.select("node", *group).join(merged.drop("node"), group)
    return leaves.join(down, ["node", *group]).drop("node")


def mark_duplicates(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    keep: str = "smallest",
    fan_in: int = FAN_IN,
    depth: int = DEPTH,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    ``row`` (hash of the whole row) and ``digest`` find the row in ``docs`` again.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep!r}")
    keyed = materialize(
        _keyed(docs, text_col, id_col).withColumn("row_id", F.monotonically_increasing_id()),
        "digests",
    )
    if keep == "largest":
        marked = merge_tree(keyed, GROUP, F.struct("id", "row", "row_id"), F.max, fan_in, depth)
    else:
        best = F.struct(F.col("id").isNull().alias("no_id"), "id", "row", "row_id")
        marked = merge_tree(keyed, GROUP, best, F.min, fan_in, depth)
    return marked.select(
        "id",
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row_id") == F.col("best.row_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row",
        "digest",
        (F.col("row") == F.col("best.row")).alias("like_kept"),
    )


def drop_duplicates(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", keep: str = "smallest"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    marked = mark_duplicates(docs, text_col, id_col, keep)
    alike = marked.where("like_kept").groupBy("digest", "row").agg(F.count(F.lit(1)).alias("n"))
    kept = materialize(gathered(alike), "kept")
    return pick_rows(docs, kept, _normalised(text_col))


def pick_rows(docs: DataFrame, kept: DataFrame, text: Column) -> DataFrame:
    """The rows of ``docs`` that ``kept`` (row hash, SHA-256 of ``text``, ``n``) names, once each.

    ``n`` is the number of fully identical rows behind one entry; where it is over one, the
    copies are dropped.
    """
    row, digest, n = (unused_name(docs, x) for x in ("row", "digest", "n"))
    kept = kept.select(F.col("row").alias(row), F.col("digest").alias(digest), F.col("n").alias(n))
    found = docs.select(
        "*", row_hash(docs).alias(row), F.unhex(F.sha2(text, 256)).alias(digest)
    )
    # The entries are narrow and unique: hashed, so that the texts are moved but not sorted.
    single = found.join(kept.where(F.col(n) == 1).hint("shuffle_hash"), [row, digest])
    repeated = kept.where(F.col(n) > 1)
    if not repeated.isEmpty():
        copies = found.join(repeated, [row, digest])
        single = single.unionByName(copies.dropDuplicates([row, digest]))
    return single.select(*[F.col(f"`{c}`") for c in docs.columns])
