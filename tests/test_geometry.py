"""Meshes from tables, resampling and boxes along neurites against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborlake.operators import meshes, resampling, spatial, trees

NODES = "node_id long, parent_id long, skeleton_id long, x double, y double, z double, radius double"


def sphere(n=40, radius=10.0):
    """Corners and faces of a ball of n rings, about 2 n^2 faces; its corners lie on round numbers, so rays meet them."""
    v = [(0.0, 0.0, -radius)] + [tuple(round(radius * c, 3) for c in (math.cos(b) * math.cos(a), math.cos(b) * math.sin(a), math.sin(b))) for b in (math.pi * (i / n - 0.5) for i in range(1, n)) for a in (2 * math.pi * j / n for j in range(n))] + [(0.0, 0.0, radius)]
    at = lambda i, j: 1 + (i - 1) * n + j % n
    f = [(0, at(1, j + 1), at(1, j)) for j in range(n)] + [(len(v) - 1, at(n - 1, j), at(n - 1, j + 1)) for j in range(n)]
    f += [t for i in range(1, n - 1) for j in range(n) for t in ((at(i, j), at(i, j + 1), at(i + 1, j)), (at(i, j + 1), at(i + 1, j + 1), at(i + 1, j)))]
    return np.array(v), np.array(f)


def test_points_in_a_large_mesh(spark):
    v, f = sphere()
    r = random.Random(1)
    points = [(i, *(round(r.uniform(-11, 11), 2) for _ in range(3))) for i in range(1500)] + [(5000 + i, *map(float, (x, y, z))) for i, (x, y, z) in enumerate(v[::7] * 0.98)] + [(9000, 0.0, 0.0, 0.0), (9001, 0.0, 0.0, -50.0), (9002, 0.0, 0.0, 50.0), (9003, None, 0.0, 0.0)]
    df = spark.createDataFrame(points, "point_id long, x double, y double, z double")
    volume = meshes.volume_of(df, v, f, "ball")
    assert len(f) > 3000
    other = meshes.volume_of(df, v + [30, 0, 0], f, "far")
    got = {(x["name"], x["point_id"]) for x in meshes.in_volumes(df.selectExpr("*", "1 AS i", "2 AS face", "3 AS top"), volume.unionByName(other)).collect()}
    size = {p[0]: math.dist(p[1:], (0, 0, 0)) for p in points if None not in p}
    assert {("ball", i) for i, s in size.items() if s < 9.9} <= got and not {("ball", i) for i, s in size.items() if s > 10.0} & got
    assert {n for n, _ in got} == {"ball"}
    assert {x["point_id"] for x in spatial.in_mesh(df, v, f).collect()} == {i for _, i in got}
    # whatever the order of corners and faces
    turned = volume.withColumn("corner", -F.col("corner")).withColumn("face", -F.col("face")).repartition(5)
    assert {(x["name"], x["point_id"]) for x in meshes.in_volumes(df, turned).collect()} == got


def test_odd_meshes(spark):
    df = spark.createDataFrame([(1, 0.5, 0.5, 0.5), (2, 1.5, 0.5, 0.5)], "point_id long, x double, y double, z double")
    none = spark.createDataFrame([], meshes.VOLUME)
    assert meshes.in_volumes(df, none).collect() == [] and meshes.in_volumes(df.limit(0), none).collect() == []
    wall = spark.createDataFrame([("w", 1, k, 0.0, float(k), float(k % 2)) for k in range(3)] + [("w", 2, 0, 0.0, 0.0, None)], meshes.VOLUME)
    assert meshes.in_volumes(df, wall).collect() == []
    # a box in a box is a hole
    v = np.array([[a, b, c] for a in (0, 1) for b in (0, 1) for c in (0, 1)], float)
    f = np.array([[0, 1, 3], [0, 3, 2], [4, 6, 7], [4, 7, 5], [0, 4, 5], [0, 5, 1], [2, 3, 7], [2, 7, 6], [0, 2, 6], [0, 6, 4], [1, 5, 7], [1, 7, 3]])
    shell = meshes.volume_of(df, np.concatenate((v * 3 - 1, v)), np.concatenate((f, f + 8)))
    assert {x["point_id"] for x in meshes.in_volumes(df, shell).collect()} == {2}


def test_prune_by_volume(spark):
    v, f = sphere(12)
    rows = [(i, i - 1 if i else None, 1, float(i), 0.0, 0.0, 1.0) for i in range(20)] + [(99, None, 2, 1.0, 1.0, 1.0, 1.0)]
    n = spark.createDataFrame(rows, NODES)
    volume = meshes.volume_of(n, v, f)
    inside = {(x["node_id"], x["parent_id"]) for x in meshes.prune_by_volume(n, volume).collect()}
    assert (0, None) in inside and (5, 4) in inside and (99, None) in inside and max(i for i, _ in inside if i < 99) in (9, 10)
    out = {x["node_id"]: x["parent_id"] for x in meshes.prune_by_volume(n, volume, "OUT").collect()}
    assert set(out) == {r[0] for r in rows} - {i for i, _ in inside} and out[min(out)] is None and out[15] == 14
    assert [tuple(x) for x in meshes.skeletons_in_volumes(n, volume, 2).collect()] == [("mesh", 1, len(inside) - 1)]
    with pytest.raises(ValueError):
        meshes.prune_by_volume(n, volume, "NEAR")


def branched(seed=2):
    r = random.Random(seed)
    rows = [(0, None, 1, 0.0, 0.0, 0.0, 1.0)]
    for i in range(1, 60):
        parent = i - 1 if r.random() < 0.75 else r.randrange(i)
        p = rows[parent]
        rows.append((i, parent, 1, p[3] + r.random() * 3, p[4] + r.random(), p[5] + (r.random() if i != 9 else 0.0), r.random()))
    rows[31] = (31, rows[31][1], 1, *rows[rows[31][1]][3:6], 0.5)  # an edge without length
    return rows + [(100, None, 2, 5.0, 5.0, 5.0, 1.0), (200, None, 3, 0.0, 0.0, 0.0, 1.0), (201, 200, 3, 0.0, 0.0, 0.0, 1.0)]


@pytest.mark.parametrize("step", [0.7, 2.5, 1000.0])
def test_resample(spark, step):
    rows = branched()
    at, kids = {r[0]: r for r in rows}, {}
    for r in rows:
        kids.setdefault(r[1], []).append(r[0])
    df = spark.createDataFrame(rows, NODES)
    got = resampling.resample(df, step).collect()
    assert [(c.name, c.dataType) for c in resampling.resample(df, step).schema] == [(c.name, c.dataType) for c in df.schema]
    new = {x["node_id"]: x for x in got}
    assert len(new) == len(got)
    stays = [i for i in at if at[i][1] is None or len(kids.get(i, [])) != 1]
    assert {i for i in new if i <= 201} == set(stays) and all(new[i]["radius"] == at[i][6] for i in stays)
    total = 0
    for end in (i for i in stays if at[i][1] is not None):
        way = [end]
        while way[-1] == end or way[-1] not in stays:
            way.append(at[way[-1]][1])
        place = [np.array(at[i][3:6]) for i in reversed(way)]
        run = np.concatenate(([0], np.cumsum([np.linalg.norm(q - p) for p, q in zip(place, place[1:])])))
        parts = max(1, int(math.floor(run[-1] / step + 0.5)))
        want = [np.array([np.interp(run[-1] * k / parts, run, [p[c] for p in place]) for c in range(3)]) for k in range(parts + 1)]
        chain = [end]
        for _ in range(parts):
            chain.append(new[chain[-1]]["parent_id"])
        assert chain[-1] == way[-1] and all(i > 201 for i in chain[1:-1])
        for i, w in zip(reversed(chain), want):
            assert [new[i][c] for c in "xyz"] == pytest.approx(w.tolist(), abs=1e-9)
        assert {new[i]["skeleton_id"] for i in chain} == {at[end][2]}
        total += parts - 1
    assert len(new) == len(stays) + total


def test_resample_edges(spark):
    df = spark.createDataFrame(branched(), NODES)
    assert resampling.resample(df.limit(0), 1.0).collect() == []
    assert {x["node_id"] for x in resampling.resample(df.where("node_id >= 100"), 0.1).collect()} == {100, 200, 201}
    with pytest.raises(ValueError):
        resampling.resample(df, 0)
    chain = spark.createDataFrame([(i, i - 1 if i else None, 1, float(i), 0.0, 0.0, 1.0) for i in range(2000)], NODES)
    far = resampling.resample(chain, 10.0)
    assert far.count() == 201 and trees.depths(far).agg(F.max("distance")).first()[0] == pytest.approx(1999)


def test_boxes_along(spark):
    rows = [(1, None, 1, 100.0, 10.0, 0.0, 1.0), (2, 1, 1, 90.0, 50.0, 200.0, 1.0), (3, 2, 1, 91.0, 51.0, 190.0, 1.0), (4, 2, 1, 0.0, 0.0, 240.0, 1.0), (9, None, 2, -1.0, 0.0, 7.0, 1.0)]
    got = {tuple(x) for x in resampling.boxes_along(spark.createDataFrame(rows, NODES), (10, 20), 40).collect()}
    box = lambda seg, node, step, x, y, z: (seg, node, step, int(x - 5), int(x + 5), int(y - 10), int(y + 10), z)
    want = {box(4, 4, 0, 0, 0, 240), box(4, 4, 1, 90, 50, 200), box(3, 3, 0, 91, 51, 190), box(3, 3, 1, 90, 50, 200), box(9, 9, 0, -1, 0, 7)}
    want |= {box(4, 2, k, 90 + int(10 / 5 * k), 50 + int(-40 / 5 * k), 200 - 40 * k) for k in range(1, 5)} | {box(4, 2, 5, 100, 10, 0)}
    assert got == want
    assert resampling.boxes_along(spark.createDataFrame(rows, NODES), (10, 20), None).count() == 6


@pytest.mark.parametrize("step", [0.3, 1.0, 4.0])
def test_resampled_with_parents(spark, step):
    """Each node knows its parent's place as a join of all new nodes would find it, branches, bent stretches and single nodes included."""
    rng = np.random.default_rng(2)
    rows = [(i, None if i in (0, 20) else max(i - 1 - int(rng.integers(3)) * (i % 4 == 0), 0 if i < 20 else 20), *map(float, rng.random(3) * 3), 1.0, 5) for i in range(26)] + [(90, None, 0.0, 0.0, 0.0, 1.0, 5)]
    df = spark.createDataFrame(rows, "node_id long, parent_id long, x double, y double, z double, radius double, confidence int")
    got = resampling.resampled(df, step).collect()
    at = {x["node_id"]: (x["x"], x["y"], x["z"]) for x in got}
    assert len(at) == len(got) and len(got) > 12
    for x in got:
        own = (x["px"], x["py"], x["pz"])
        assert own == (None, None, None) if x["parent_id"] is None else own == pytest.approx(at[x["parent_id"]], abs=1e-12)
