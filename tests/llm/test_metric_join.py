"""The metric range join against all pairs, however its cells are cut."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest

from tallyrank.llm import metric_join


def by_hand(rows, threshold=0.93):
    """(id, vector, label) rows: n_links and component_id of each, from all pairs."""
    ok = [
        v is not None and l is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for _, v, l in rows
    ]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    links = [0] * len(rows)
    groups = defaultdict(list)
    for i, (_, v, l) in enumerate(rows):
        if ok[i]:
            groups[l, len(v)].append(i)
    for members in groups.values():
        x = np.array([rows[i][1] for i in members], dtype=float)
        x /= np.sqrt((x * x).sum(1))[:, None]
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1))):
            i, j = members[a], members[b]
            links[i] += 1
            links[j] += 1
            up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (key, _, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), key), key, key=lambda k: (k is None, k or 0))
    return [(rows[i][0], links[i], least[root(i)]) for i in range(len(rows))]


def near_copies(rng, n, dim, spread):
    return rng.normal(size=dim) + spread * rng.normal(size=(n, dim))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    parts = [
        (near_copies(rng, 300, 8, 0.05), 0),  # all link: a dense group
        (near_copies(rng, 200, 8, 0.45), 0),  # some link, in chains
        (near_copies(rng, 150, 8, 0.7), 0),
        (rng.normal(size=(250, 8)), 0),
        (rng.normal(size=(60, 8)), 1),
        (near_copies(rng, 40, 8, 0.2), 2),
    ]
    found = [(v.astype(np.float32).astype(float).tolist(), label) for vs, label in parts for v in vs]
    found += [found[5]] * 200 + [found[-1]] * 3  # exact copies
    rows = [(i, v, label) for i, (v, label) in enumerate(found)]
    rng.shuffle(rows)
    odd = [(-1, None, 0), (-2, [0.0] * 8, 0), (-3, [1.0] * 7 + [None], 0), (-4, [math.nan] * 8, 1),
           (-5, [math.inf] * 8, 0), (-6, found[5][0], None), (-7, [], 0), (-8, [1.0, 2.0], 0), (-9, [2.0, 4.0], 0)]
    return [(int(i), v, None if l is None else int(l)) for i, v, l in rows] + odd


@pytest.mark.parametrize("cell,pivot_bytes", [(2_048, 1 << 20), (100, 1 << 20), (12, 1 << 20), (30, 200), (40, 0)])
def test_equals_all_pairs(spark, rows, cell, pivot_bytes):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = metric_join.near_duplicates(frame, keep=["vec_id"], cell=cell, pivot_bytes=pivot_bytes)
    got = got.select("vec_id", "near.n_links", "near.component_id").collect()
    assert sorted(map(tuple, got)) == sorted(by_hand(rows))


def test_pivots_stand_apart_and_units_hold_all(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    nodes = metric_join._nodes(metric_join._rows(frame, "embedding", "vec_id", "label", []))
    sizes = nodes.groupBy("label", "dim").count().withColumnRenamed("count", "size")
    reach = metric_join.reach_of(0.93)
    pivots = metric_join.choose_pivots(nodes, sizes, "<f4", reach, 30, 1 << 20)
    assert (0, 8) in pivots.keys and len(pivots.points) == len(pivots.keys)
    for points in pivots.points:
        d = metric_join._distances(points, points) + 9 * np.eye(len(points))
        assert d.min() > reach
    units = metric_join._units(metric_join._at_home(nodes, pivots, "<f4", reach))
    # The dense group is in inner rings, where nothing is compared.
    assert max(u.n_nodes for u in units if u.ring == 0) > 200


def test_odd_tables(spark):
    schema = "vec_id long, near array<double>, label string, id int, node int"
    frame = spark.createDataFrame(
        [(None, [1.0, 0.0], "a", 1, 1), (None, [1.0, 0.0], "a", 2, 2), (7, [0.0, 1e-200], "a", 3, 3),
         (7, [0.0, 1e200], "a", 4, 4), (8, [0.93, math.sqrt(1 - 0.93**2)], "a", 5, 5), (None, None, "a", 6, 6)],
        schema,
    )
    marked = metric_join.near_duplicates(frame, "near")
    assert marked.columns == ["vec_id", "near", "label", "id", "node", "_near"]
    got = {r["id"]: (r["n_links"], r["component_id"]) for r in marked.select("id", "_near.*").collect()}
    assert got == {1: (2, 8), 2: (2, 8), 3: (1, 7), 4: (1, 7), 5: (2, 8), 6: (0, None)}
    kept = metric_join.drop_near_duplicates(frame, vector_col="near")
    assert kept.columns == frame.columns
    assert len(kept.collect()) == 3 and {r["vec_id"] for r in kept.collect()} == {None, 7, 8}
    assert metric_join.near_duplicates(frame.where("false"), "near").count() == 0
    with pytest.raises(ValueError, match="threshold"):
        metric_join.near_duplicates(frame, "near", threshold=0.0)
