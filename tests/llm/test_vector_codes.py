"""Vector codes: bounds never change a result, whatever they leave out."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tallyrank.llm import vector_codes


def by_hand(rows, parts=4, entries=256, rounds=4):
    """(id, vector) rows, all valid: codes and errors by row, and the codebooks."""
    longest = max((len(v) for _, v in rows), default=0)
    wide = -(-longest // parts)
    whole = [[math.floor(1024 * x) for x in v] + [0] * (wide * parts - len(v)) for _, v in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, whole[i]))
    part = lambda i, p: whole[i][p * wide : (p + 1) * wide]
    books = [[part(i, p) for i in order[:entries]] for p in range(parts)]

    def nearest(p):
        x = np.array([part(i, p) for i in range(len(rows))], dtype=np.int64)
        d = ((x[:, None] - np.array(books[p])[None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        for p in range(parts):
            code, _ = nearest(p)
            for e in range(len(books[p])):
                mine = [part(i, p) for i in np.flatnonzero(code == e)]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [nearest(p) for p in range(parts)]
    codes = [[int(f[0][i]) for f in found] for i in range(len(rows))]
    return codes, [sum(int(f[1][i]) for f in found) for i in range(len(rows))], books


def clustered(n, dim, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return (centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dim))).round(3)


@pytest.mark.parametrize("nearest", [1, 3, 40])
@pytest.mark.parametrize("as_float", [True, False])
def test_bounds_change_nothing(nearest, as_float):
    rng = np.random.default_rng(nearest)
    x = np.floor(1024 * clustered(3_000, 5, 2, 0.3)).astype(np.float64 if as_float else np.int64)
    x[::7] = x[0]  # ties: copies of a vector, and of an entry
    book = x[:60].copy()
    book[31] = book[30]
    bounds, best = vector_codes.look_at_all(x, book, nearest)
    looked = []
    for turn in range(6):
        new = book + rng.integers(-30, 31, book.shape) // (turn + 1)
        moved = np.sqrt(((new - book).astype(float) ** 2).sum(1)) * vector_codes._UP
        book = new.astype(x.dtype)
        b = max(1, nearest + turn % 3 - 1)
        bounds, best, used = vector_codes.look_again(x, book, bounds.resized(b), moved)
        exact = vector_codes.squared_to_all(x, book)
        assert bounds.code.tolist() == exact.argmin(1).tolist()
        assert best.tolist() == exact.min(1).tolist()
        looked.append((used > b).mean())
        # Every entry outside the list is beyond the outer bound, all in it beyond theirs.
        for i in range(0, len(x), 97):
            listed = {int(e): l for e, l in zip(bounds.near[i], bounds.low[i]) if l < np.inf}
            for e, d in enumerate(np.sqrt(exact[i].astype(float))):
                if e != bounds.code[i]:
                    assert listed.get(e, bounds.outer[i]) <= d
    if nearest == 40:
        assert min(looked) < 0.2  # most parts never meet all entries again


def test_width_follows_the_need():
    assert vector_codes.next_width({0: 500, 4: 480, 9: 20}, 8, 256) == 4
    assert vector_codes.next_width({0: 990, 1: 9, 9: 1}, 8, 256) <= 2
    assert vector_codes.next_width({9: 1_000}, 8, 256) == 8
    assert vector_codes.next_width({0: 500, 8: 300, 9: 200}, 8, 256) == 16
    assert vector_codes.next_width({0: 500, 8: 300, 9: 200}, 8, 15) == 14


def test_equals_plain_rounds(spark):
    rng = random.Random(5)
    vectors = clustered(700, 10, 4).tolist()
    rows = [(i, v, rng.choice([0, 1, None])) for i, v in enumerate(vectors)]
    rows += [(3, rows[3][1], 1), (3, [0.5] * 10, 1), (None, [0.25] * 10, None), (900, [], 2), (901, [1.0], 2)]
    rows += [(i, rows[5][1], 3) for i in range(1_000, 1_300)]  # a third are copies
    valid = [(i, v) for i, v, _ in rows]
    odd = [(-5, None, 0), (-4, [1.0, None], 0), (-3, [float("nan")] * 10, 0), (-2, [float("inf")] * 10, None)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, v array<double>, codes int").repartition(4)
    coded, books = vector_codes.compress(frame, "v", name="codes", entries=40)
    assert coded.columns == ["vec_id", "v", "codes", "_codes"]
    codes, errors, want = by_hand(valid, entries=40)
    assert books.tolist() == want
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3])
    got = [(r[0], r[1], r[2], r[3]) for r in coded.select("vec_id", "v", "_codes.codes", "_codes.error").collect()]
    assert sorted(got, key=order) == sorted(
        [(i, v, c, e) for (i, v), c, e in zip(valid, codes, errors)], key=order
    )


def test_few_rows_none_and_too_large(spark):
    schema = "vec_id long, embedding array<float>, label int"
    coded, books = vector_codes.compress(spark.createDataFrame([], schema))
    assert coded.count() == 0 and books.size == 0
    coded, books = vector_codes.compress(spark.createDataFrame([(1, [], 0), (2, [], 0)], schema))
    assert [r[0] for r in coded.select("coded.codes").collect()] == [[0] * 4] * 2
    one = spark.createDataFrame([(1, [0.5, -0.5, 0.25, 1e-4], 0)], schema)
    coded, books = vector_codes.compress(one)
    assert coded.select("coded.*").first() == ([0] * 4, 0)
    assert books.ravel().tolist() == [512, -512, 256, 0]
    wide = spark.createDataFrame([(i, [30_000.0 * (i % 3), 0.1 * i], 0) for i in range(9)], schema)
    coded, _ = vector_codes.compress(wide, entries=3, parts=1)
    assert coded.select("coded.codes").distinct().count() == 3
    with pytest.raises(ValueError, match="too large"):
        vector_codes.compress(spark.createDataFrame([(1, [3e38] * 4, 0)], schema))
