"""Medians of the ways between pairs of contacts, against all pairs."""

import statistics

import numpy as np
import pytest

from arborlake.operators import tree_medians, trees


def brute(parent, xyz, contacts):
    def up(i):
        out, d = {i: 0.0}, 0.0
        while parent[i] is not None:
            d += float(np.linalg.norm(np.subtract(xyz[i], xyz[parent[i]])))
            out[i := parent[i]] = d
        return out

    ups, found = {i: up(i) for i in parent}, {}
    for g in {g for g, _ in contacts}:
        own = [i for h, i in contacts if h == g and i in parent]
        d = [min(ups[a][k] + ups[b][k] for k in ups[a].keys() & ups[b].keys()) for n, a in enumerate(own) for b in own[n + 1 :] if ups[a].keys() & ups[b].keys()]
        if d:
            found[g] = statistics.median(d)
    return found


@pytest.mark.parametrize("shape,few", [("random", 3), ("random", 100_000), ("chain", 2), ("star", 1), ("alike", 4)])
def test_median_distances(spark, shape, few):
    rng = np.random.default_rng(8)
    parent = {i: {"random": i - 1 - int(rng.integers(min(i, 9))), "chain": i - 1, "star": 0, "alike": i // 2}[shape] if i not in (0, 50) else None for i in range(60)}
    xyz = {i: (float(rng.integers(9)), 0.0, float(rng.random())) if shape != "alike" else (float(i.bit_length()), 0.0, 0.0) for i in parent}
    nodes = spark.createDataFrame([(i, p, *xyz[i]) for i, p in parent.items()], "node_id long, parent_id long, x double, y double, z double")
    contacts = [(int(g), int(i)) for g, i in zip(rng.integers(4, size=90), rng.integers(62, size=90))] + [(7, 3), (8, 1), (8, 55), (9, 4), (9, 4)]
    df = spark.createDataFrame(contacts + [(None, 1), (None, 2)], "grp long, node_id long")
    got = {x["grp"]: x["d"] for x in tree_medians.median_distances(nodes, df, few).collect()}
    assert got == pytest.approx(brute(parent, xyz, contacts), abs=1e-9)


def test_density_of_many(spark):
    """Of the median of eight million pairs few are made: half of the contacts sit on one node, the others hang on the root."""
    n = 4000
    nodes = spark.range(n).selectExpr("id AS node_id", "CASE WHEN id > 0 THEN 0L END AS parent_id", "0D AS x", "0D AS y", "CAST(id % 7 AS DOUBLE) AS z")
    contacts = spark.range(n).selectExpr("1L AS grp", "CASE WHEN id % 2 = 0 THEN 3999L ELSE id END AS node_id")
    at = np.where(np.arange(n) % 2 == 0, 3999, np.arange(n))
    d = np.where(np.equal.outer(at, at), 0, np.add.outer(at % 7, at % 7))[np.triu_indices(n, 1)]
    assert trees.connection_density(nodes, contacts, normalise=100).first()["density"] == pytest.approx(100 / np.median(d))
    assert trees.connection_density(nodes.limit(0), contacts).first()["density"] is None
