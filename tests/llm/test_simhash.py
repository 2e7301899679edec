"""SimHash against its definition and all-pairs linking."""

from __future__ import annotations

import random
import re
import string

import pytest
import xxhash
from pyspark.sql import functions as F

from tallyrank.llm import simhash

_LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOW))
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(values):
    """All pairs, for small lists only."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in root:
        for b in root:
            if a < b and (a ^ b).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in root}


def _signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize(
    "text",
    [None, "", " \t\n\x0b\x0c\r", "One", "one two", "a b c", "A b C d", "é\u00a0ü ß x y z", "w " * 90_000],
)
def test_fingerprint(text):
    assert simhash.simhash(None if text is None else text.encode()) == _plain(text)


@pytest.mark.parametrize("bits", [2, 4])
def test_links_connect_what_all_pairs_connect(spark, bits):
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1, 1 << 63}
    for base in list(values)[:20]:
        for flips in (1, 2, 2, 3, 4):
            for _ in range(4):
                value = base
                for b in rng.sample(range(64), flips):
                    value ^= 1 << b
                values.add(value)
    dense = rng.getrandbits(64)
    values |= {dense ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)}
    df = spark.createDataFrame([(_signed(v),) for v in values], "fp long").repartition(4)
    close = simhash._not_alone(df, bits)
    near = {v for v in values if any(v != w and (v ^ w).bit_count() <= 2 for w in values)}
    assert {_signed(v) for v in near} <= {r["fp"] for r in close.collect()}
    links = simhash._links(close)
    assert links.count() <= 65 * len(values)
    roots = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    want = _components(values)
    groups: dict = {}
    for v in values:
        groups.setdefault(want[v], set()).add(roots.get(_signed(v), _signed(v)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdef", k=4)) for _ in range(300)]
    rows = []
    for i in range(40):
        base = rng.choices(words, k=400)
        rows.append((100 + i, " ".join(base), "x"))
        rows.append((i, " ".join(base).upper(), "y"))
        if i % 4 == 0:
            base[7] = "changed"
            rows.append((200 + i, " ".join(base), "x"))
    rows += [(500, None, "a"), (501, "", "a"), (502, " ", "b"), (None, "", "c"), (7, rows[14][1], "z")]
    rows += [(600, "one row", "q")] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(3), rows


def test_near_duplicates_equal_all_pairs(docs):
    df, rows = docs
    prints = [_plain(r[1]) for r in rows]
    root = _components(prints)
    groups: dict = {}
    for row, fp in zip(rows, prints):
        groups.setdefault(root[fp], []).append(row[0])
    got = simhash.near_duplicates(df).collect()
    want = sorted(
        (str(r[0]), fp, min(i for i in groups[root[fp]] if i is not None), len(groups[root[fp]]))
        for r, fp in zip(rows, prints)
    )
    assert want == sorted(
        (str(r["id"]), r["fp"] % (1 << 64), r["component_id"], r["component_size"]) for r in got
    )
    assert sum(r["kept"] for r in got) == len(groups)


def test_one_of_each_component_stays(docs):
    df, rows = docs
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    got = kept.collect()
    assert len(got) == simhash.near_duplicates(df).where("kept").count()
    assert {tuple(r) for r in got} <= set(rows)
    assert simhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_places_do_not_repeat(spark):
    df = spark.createDataFrame([(5,), (-1,)], "fp long").select(
        "fp", simhash._place(2).alias("place")
    )
    steps = df.select("fp", F.explode(simhash._within_a_step(2)).alias("p")).where("p is not null")
    assert steps.count() == steps.distinct().count()


@pytest.mark.parametrize("distance", [0, 1, 3])
def test_other_distances_are_refused(spark, distance):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="2 bits"):
        simhash.near_duplicates(docs, max_distance=distance)
