"""Closest pairs at any distance and joined skeletons, against all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from arborlake.operators import mutate, spatial, stitching, trees

NODES = "node_id long, parent_id long, skeleton_id long, x double, y double, z double, radius double"


def points_of(seed, n, spread=1.0, far=0):
    r = random.Random(seed)
    out = [(i, *(round(r.gauss(0, spread), 3) for _ in range(3))) for i in range(n)]
    return out + [(n + i, *(r.choice((-1, 1)) * 10.0 ** (3 + i) for _ in range(3))) for i in range(far)]


def dist(p, q):
    return math.dist(p[-3:], q[-3:])


def test_nearest_at_any_distance(spark):
    a, b = points_of(1, 150, far=4), points_of(2, 200, 0.5, far=2)
    b += [(500, *b[3][1:]), (501, *b[3][1:])]
    a += [(600, *b[3][1:]), (601, 5.0, None, 0.0)]
    df = lambda rows: spark.createDataFrame(rows, "point_id long, x double, y double, z double").selectExpr("*", "1 AS own", "2 AS grp", "3 AS cx")
    got = {r["a"]: (r["b"], r["distance"]) for r in stitching.nearest_any(df(a), df(b)).collect()}
    assert set(got) == {p[0] for p in a if None not in p}
    for p in a:
        if None not in p:
            d, q = min((dist(p, q), q[0]) for q in b)
            assert got[p[0]] == (q, pytest.approx(d)) or got[p[0]][1] == pytest.approx(d) and abs(dist(p, next(x for x in b if x[0] == got[p[0]][0])) - d) < 1e-9
    assert stitching.nearest_any(df(a), df(b).limit(0)).collect() == []
    one = df([(9, 1.0, 2.0, 3.0)] * 2)
    assert {(r["b"], r["a"]) for r in stitching.nearest_any(df(a), one).collect()} == {(9, p[0]) for p in a if None not in p}


def test_closest_of_groups(spark):
    r = random.Random(3)
    rows = [(g, 100 * g + i, *(c + r.gauss(0, 0.4) for c in (5.0 * (g % 3), 0.3 * g, 0))) for g in range(12) for i in range(25)]
    rows += [(20, 5000, 1e6, 0.0, 0.0), (21, 5001, 1e6, 0.0, 0.0), (22, 5002, 1e6, 0.0, 0.0), (23, 5003, -1e5, 3.0, 1.0)]
    a = spark.createDataFrame(rows, "grp long, point_id long, x double, y double, z double")
    got = {x["grp"]: x for x in stitching.closest(a, a.withColumnRenamed("grp", "own")).collect()}
    at = {p[1]: p for p in rows}
    assert set(got) == {p[0] for p in rows}
    for g, x in got.items():
        assert x["distance"] == pytest.approx(min(dist(p, q) for p in rows if p[0] == g for q in rows if q[0] != g)) == pytest.approx(dist(at[x["a"]], at[x["b"]]))
        assert at[x["a"]][0] == g != at[x["b"]][0]
    alone = a.where("grp = 3")
    assert stitching.closest(alone, alone.withColumnRenamed("grp", "own")).collect() == []


def least_total(points):
    """Length of the least spanning tree over groups (Kruskal over all pairs)."""
    up = {p[0]: p[0] for p in points}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    total = 0.0
    for d, a, b in sorted((dist(p, q), p[0], q[0]) for i, p in enumerate(points) for q in points[:i] if p[0] != q[0]):
        if top(a) != top(b):
            up[top(a)] = top(b)
            total += d
    return total


def skeletons(seed=5, n=9, same=False):
    """Chains with a side branch, some of them in several fragments, some on top of one another."""
    r, rows, k = random.Random(seed), [], 0
    for s in range(n):
        x, y, z = (0.0, 0.0, 0.0) if same and s % 3 == 0 else tuple(r.uniform(0, 60) for _ in range(3))
        for i in range(3 + s % 5):
            parent = None if i == 0 or (s % 4 == 3 and i == 2) else k - 1 if i != 4 else k - 3
            rows.append((k, parent, s // 2 if s % 4 == 1 else 50 + s, x + i, y + r.random() * (not same), z, 1.0))
            k += 1
    return rows


@pytest.mark.parametrize("method, same", [("LEAFS", False), ("ALL", False), ("ALL", True), ("LEAFS", True)])
def test_join_skeletons(spark, method, same):
    rows = skeletons(same=same)
    df = spark.createDataFrame(rows, NODES)
    root = {x["node_id"]: x["root"] for x in trees.fragments(df).collect()}
    got = stitching.join_skeletons(df, method=method).collect()
    assert sorted(x["node_id"] for x in got) == [r[0] for r in rows]
    count = {}
    for r in rows:
        count[r[2]] = count.get(r[2], 0) + 1
    winner = min(count, key=lambda s: (-count[s], s))
    assert {x["skeleton_id"] for x in got} == {winner}
    tops = [x["node_id"] for x in got if x["parent_id"] is None]
    assert len(tops) == 1 and tops[0] == root[tops[0]] and next(r[2] for r in rows if r[0] == tops[0]) == winner
    # one tree: every node reaches the root
    up = {x["node_id"]: x["parent_id"] for x in got}
    for i in up:
        seen = set()
        while i is not None:
            assert i not in seen
            seen.add(i)
            i = up[i]
    at = {r[0]: r for r in rows}
    old = {frozenset((r[0], r[1])) for r in rows if r[1] is not None}
    new = [tuple(e) for e in ({frozenset((i, p)) for i, p in up.items() if p is not None} - old)]
    assert len(new) == len(set(root.values())) - 1 and old <= {frozenset((i, p)) for i, p in up.items() if p is not None}
    kids = {}
    for r in rows:
        kids[r[1]] = kids.get(r[1], 0) + 1
    allowed = [r[0] for r in rows if method == "ALL" or r[1] is None or not kids.get(r[0])]
    assert all(i in set(allowed) for e in new for i in e)
    place = lambda i: at[i][3:6]
    assert sum(math.dist(place(a), place(b)) for a, b in new) == pytest.approx(least_total([(root[i], *place(i)) for i in allowed]))


def test_join_skeletons_of_a_winner(spark):
    rows = [(1, None, 7, 0.0, 0.0, 0.0, 1.0), (2, 1, 7, 1.0, 0.0, 0.0, 1.0), (3, None, 8, 1e9, 0.0, 0.0, 1.0), (4, None, 9, -5.0, 0.0, 0.0, 1.0), (5, None, 9, None, None, None, 1.0)]
    df = spark.createDataFrame(rows, NODES)
    got = {x["node_id"]: (x["parent_id"], x["skeleton_id"]) for x in stitching.join_skeletons(df, 8).collect()}
    assert got == {3: (None, 8), 2: (3, 8), 1: (2, 8), 4: (1, 8), 5: (None, 9)}
    assert {x["skeleton_id"] for x in stitching.join_skeletons(df.where("node_id < 3")).collect()} == {7}
    assert stitching.join_skeletons(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        stitching.join_skeletons(df, 99)
    with pytest.raises(ValueError):
        stitching.join_skeletons(df, method="SOME")


def test_replaced_skeleton_has_no_lost_links(spark):
    old = [(i, i - 1 if i else None, 1, float(i), 0.0, 0.0, 1.0) for i in range(6)] + [(50, None, 2, 0.0, 0.0, 0.0, 1.0)]
    new = [(100, None, 1, 2.2, 0.0, 0.0, 1.0), (101, 100, 1, 900.0, 0.0, 0.0, 1.0)]
    links = spark.createDataFrame([(1, 0), (2, 5), (3, 50), (4, 0)], "connector_id long, node_id long")
    nodes, moved = mutate.replace_skeleton(spark.createDataFrame(old, NODES), spark.createDataFrame(new, NODES), links, 1)
    assert {tuple(x) for x in moved.collect()} == {(1, 100), (2, 100), (3, 50), (4, 100)} and nodes.count() == 3
    assert {tuple(x) for x in mutate.replace_skeleton(spark.createDataFrame(old, NODES), spark.createDataFrame(new, NODES), links, 1, 2.5)[1].collect()} == {(1, 100), (2, None), (3, 50), (4, 100)}


def test_placement_without_a_reach(spark):
    """Synapses further apart than eight sigma count with what little they add."""
    r = random.Random(8)
    rows = [(i, i % 3, i % 2, r.uniform(0, 40), r.uniform(0, 40), 0.0) for i in range(60)]
    df = spark.createDataFrame(rows, "point_id long, neuron long, kind long, x double, y double, z double")
    got = {(x["a"], x["b"]): x["similarity"] for x in spatial.synapse_similarity(df, 1.5, 3.0, reach=None).collect()}
    own = {p[0]: sum(dist(p, q) <= 3.0 for q in rows if q[1:3] == p[1:3]) for p in rows}
    for a in range(3):
        for b in range(3):
            mine, total = [p for p in rows if p[1] == a], 0.0
            for p in mine:
                d, _, k = min((dist(p, q), q[0], own[q[0]]) for q in rows if q[1] == b and q[2] == p[2])
                total += math.exp(-abs(own[p[0]] - k) / (own[p[0]] + k)) * math.exp(-d * d / (2 * 1.5**2))
            assert got[a, b] == pytest.approx(total / len(mine), rel=1e-12)


def test_nearest_of_each_neuron_writes_no_pairs_of_points(spark, monkeypatch):
    """Of forty points of a neuron in one cell each point asks for the nearest; what is written stays near the number of asks."""
    from arborlake.operators import spatial, stitching

    r = random.Random(12)
    rows = [(i, i % 2, 0, r.random(), r.random(), r.choice([0.0, 0.5])) for i in range(80)]
    sizes, cut = [], stitching.cut
    monkeypatch.setattr(stitching, "cut", lambda df: sizes.append((out := cut(df)).count()) or out)
    df = spark.createDataFrame(rows, "point_id long, neuron int, kind int, x double, y double, z double")
    got = {(x["point_id"], x["b"]): (x["n"], x["d"]) for x in spatial._nearest_of_each(df).collect()}
    far = lambda p, q: sum((s - t) ** 2 for s, t in zip(p[3:], q[3:])) ** 0.5
    want = {(p[0], b): min((far(p, q), q[0]) for q in rows if q[1] == b) for p in rows for b in (0, 1)}
    assert got.keys() == want.keys() and all(got[k][0] == v[1] and abs(got[k][1] - v[0]) < 1e-12 for k, v in want.items())
    assert max(sizes) <= 8 * len(want)
