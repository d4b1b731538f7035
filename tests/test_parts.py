"""Density without pairs, pruning by order and the longest parts, against plain versions on small forests."""

import itertools
import random
import statistics

import pytest

from arborlake.operators import trees

NODES = "node_id long, parent_id long, x double, y double, z double"


def forest(seed=3):
    r = random.Random(seed)
    rows = []
    for t, n in enumerate((40, 25, 1, 2)):
        for i in range(n):
            rows.append((100 * t + i, 100 * t + r.randrange(max(0, i - 4), i) if i else None, r.random() * 9, r.random() * 9, 0.0))
    return rows


def ways(rows):
    at = {r[0]: r for r in rows}
    length = lambda i: 0.0 if at[i][1] is None else sum((a - b) ** 2 for a, b in zip(at[i][2:], at[at[i][1]][2:])) ** 0.5

    def up(i):
        out = [i]
        while at[out[-1]][1] is not None:
            out.append(at[out[-1]][1])
        return out

    return at, length, up


@pytest.mark.parametrize("method", ["SUM", "AVERAGE", "MEDIAN"])
def test_density(spark, method):
    rows = forest()
    _, length, up = ways(rows)
    r = random.Random(4)
    contacts = [(g, i) for g in range(6) for i in r.sample([x[0] for x in rows], 3 * g)] + [(9, 5)]
    contacts += [] if method == "MEDIAN" else [(4, contacts[-2][1])] * 2  # repeated contacts are contacts each

    def far(a, b):
        x, y = up(a), up(b)
        return None if x[-1] != y[-1] else sum(map(length, set(x) ^ set(y)))

    want = {}
    for g in {g for g, _ in contacts}:
        d = [f for a, b in itertools.combinations([i for h, i in contacts if h == g], 2) if (f := far(a, b)) is not None]
        value = {"SUM": sum, "AVERAGE": statistics.mean, "MEDIAN": statistics.median}[method](d) if d else None
        want[g] = 100 / value if value else None
    df = spark.createDataFrame(rows, NODES)
    got = {x["grp"]: x["density"] for x in trees.connection_density(df, spark.createDataFrame(contacts, "grp long, node_id long"), method, 100).collect()}
    assert set(got) == set(want) and all(got[g] == (None if want[g] is None else pytest.approx(want[g])) for g in want)
    if method == "SUM":
        with pytest.raises(ValueError):
            trees.connection_density(df, spark.createDataFrame(contacts, "grp long, node_id long"), "MODE")


def test_orders_and_parts(spark):
    rows = forest(7)
    at, length, up = ways(rows)
    df = spark.createDataFrame(rows, NODES)
    order = {x["node_id"]: x["strahler"] for x in trees.strahler(df).collect()}
    top = {}
    for i, s in order.items():
        top[up(i)[-1]] = max(s, top.get(up(i)[-1], 0))
    for gone in ([1], [-1], [2, -2]):
        kept = {i for i, s in order.items() if s not in gone and s - top[up(i)[-1]] - 1 not in gone}
        got = {x["node_id"]: x["parent_id"] for x in trees.prune_by_strahler(df, gone).collect()}
        assert got == {i: at[i][1] if at[i][1] in kept else None for i in kept}

    # segments by longest path: each node goes with the deepest end below it
    deep = {i: sum(map(length, up(i))) for i in at}
    segment = {i: max((j for j in at if i in up(j)), key=lambda j: (deep[j], -j)) for i in at}
    for n in (1, 3, 99):
        chosen = set()
        for t in {up(i)[-1] for i in at}:
            total = {}
            for i in at:
                if up(i)[-1] == t:
                    total[segment[i]] = total.get(segment[i], 0) + length(i)
            chosen |= set(sorted(total, key=lambda s: (-total[s], s))[:n])
        want = {i: segment[next(j for j in up(i) if segment[j] in chosen)] for i in at}
        assert {x["node_id"]: x["part"] for x in trees.longest_parts(df, n).collect()} == want


def test_quantiles_by_counting(spark, monkeypatch):
    import numpy as np

    from arborlake.operators import quantiles

    r = random.Random(9)
    columns = [[r.gauss(0, 1) for _ in range(500)], [float(r.randrange(3)) for _ in range(400)], [r.random() ** 40 * 1e12 for _ in range(300)] + [5.0] * 200, [7.0], [1.0, 1.0 + 2**-52] * 3]
    monkeypatch.setattr(quantiles, "BINS", 8)
    for few in (1, 50):
        monkeypatch.setattr(quantiles, "FEW", few)
        for values in columns:
            df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 3, "v double").repartition(3)
            assert quantiles.quantiles(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0]) == pytest.approx(np.quantile(values, [0.0, 0.25, 0.5, 0.9, 1.0]).tolist(), rel=1e-12)
    assert quantiles.quantiles(df.limit(0), "v", [0.5]) == [None]
