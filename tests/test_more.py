"""Linkage on Spark against the same linkage on arrays, and operators that SQL does not cover."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborlake.functions import text
from arborlake.operators import annotations, clustering, connectivity, mutate, readers, spatial, trees

from . import linkage


@pytest.mark.parametrize("method", ["single", "complete", "average", "ward"])
def test_linkage(spark, method):
    g = np.random.default_rng(3)
    x = g.standard_normal((14, 2))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    rows = [(a, b, float(d[a, b])) for a in range(14) for b in range(14)]
    table = spark.createDataFrame(rows, "a long, b long, distance double")
    want = linkage.merge_all(d, method)
    got = sorted(r["height"] for r in clustering.merges(table, method).collect())
    assert np.allclose(got, np.sort(want[:, 2]))
    out = {r["id"]: (r["cluster"], r["position"]) for r in clustering.clusters(table, 4, method).collect()}
    assert [out[i][0] for i in range(14)] == linkage.cut_tree(want, 4).tolist()
    assert sorted(p for _, p in out.values()) == list(range(14))
    # clusters are runs of the leaf order
    order = [out[i][0] for i in sorted(out, key=lambda i: out[i][1])]
    assert sum(a != b for a, b in zip(order, order[1:])) == 3


def test_linkage_of_one_item_and_ties(spark):
    one = spark.createDataFrame([(5, 5, 0.0)], "a long, b long, distance double")
    assert [tuple(r) for r in clustering.clusters(one, 3).collect()] == [(5, 1, 0)]
    same = spark.createDataFrame([(a, b, 1.0) for a in range(5) for b in range(5) if a != b], "a long, b long, distance double")
    assert {r["cluster"] for r in clustering.clusters(same, 2, "average").collect()} == {1, 2}


def test_names(spark):
    df = spark.createDataFrame([("AD1b2#7 3080184 Dust World JJ PS",), ("neuron 12",), ("neuron alone",), ("PS",), (None,), ("",)], "n string")
    got = [tuple(r["p"]) if r["p"] else None for r in df.select(text.parse_name(F.col("n")).alias("p")).collect()]
    assert got[0] == ("AD1b2#7", "Dust World", "JJ PS", "3080184") and got[1] == ("", "", "", "neuron 12")
    assert got[2] == ("neuron alone", "", "", "") and got[3] == ("PS", "", "", "")
    short = lambda most: df.limit(1).select(text.shorten_name(F.col("n"), most).alias("s")).first()[0]
    assert short(40) == "AD1b2#7 3080184 Dust World JJ PS" and short(30) == "AD1b2#7 [..] Dust World JJ PS"
    assert short(10) == "AD1b2#7 [..]"


def test_similarity_by_placement_against_all_pairs(spark):
    r = random.Random(4)
    pts = [(i, i % 4, i % 3, r.uniform(0, 9), r.uniform(0, 9), r.uniform(0, 9)) for i in range(80)]
    got = {(x["a"], x["b"]): x["similarity"] for x in spatial.synapse_similarity(spark.createDataFrame(pts, "point_id long, neuron long, kind int, x double, y double, z double"), 1.0, 3.0).collect()}
    far = lambda p, q: sum((a - b) ** 2 for a, b in zip(p[3:], q[3:])) ** 0.5
    dense = {p[0]: sum(far(p, q) <= 3 for q in pts if q[1:3] == p[1:3]) for p in pts}
    for a in range(4):
        for b in range(4):
            total, own = 0.0, [p for p in pts if p[1] == a]
            for p in own:
                near = min(((far(p, q), q[0]) for q in pts if q[1] == b and q[2] == p[2]), default=None)
                if near:
                    total += np.exp(-abs(dense[p[0]] - dense[near[1]]) / (dense[p[0]] + dense[near[1]])) * np.exp(-(near[0] ** 2) / 2)
            assert abs(got[a, b] - total / len(own)) < 1e-9


def test_heal_and_flow(spark):
    # two chains side by side and one far away; inputs at one tip, outputs at the other
    nodes = [(i, i - 1 if i % 10 else None, float(i % 10), float(i // 10), 0.0) for i in range(20)] + [(50, None, 99.0, 99.0, 0.0)]
    df = spark.createDataFrame(nodes, "node_id long, parent_id long, x double, y double, z double")
    healed = trees.heal(df, 1.0)
    assert {(r["node_id"], r["root"]) for r in trees.fragments(healed).collect()} == {(i, 0) for i in range(20)} | {(50, 50)}
    assert healed.where("parent_id IS NULL").count() == 2
    syn = spark.createDataFrame([(9, "presynaptic_to"), (8, "presynaptic_to"), (19, "postsynaptic_to")], "node_id long, relation string")
    flow = {r["node_id"]: r for r in trees.flow(healed, syn).collect()}
    assert (flow[0]["pre_below"], flow[0]["post_below"]) == (2, 1) and flow[9]["flow"] == 1 and flow[50]["flow"] == 0
    parts = {r["node_id"]: r["part"] for r in trees.split_axon(healed, trees.flow(healed, syn)).collect()}
    assert parts[9] == "axon" and parts[19] == "dendrite"


def test_paths_stop_where_no_target_is_near(spark):
    e = spark.createDataFrame([(1, 2, 3), (2, 3, 3), (3, 1, 3), (2, 9, 3), (9, 10, 3), (1, 3, 1)], "source long, target long, weight long")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")
    got = {(tuple(r["path"]), r["hops"]) for r in connectivity.paths(e, ids(1), ids(3, 10), [1, 2, 3], 2).collect()}
    assert got == {((1, 2, 3), 2), ((1, 2, 9, 10), 3)}


def test_errors_are_raised_where_rows_are_wrong(spark):
    n = spark.createDataFrame([(1, None, 5), (2, 1, 5)], "node_id long, parent_id long, confidence int")
    with pytest.raises(Exception, match="confidence 9"):
        mutate.set_confidence(n, spark.createDataFrame([(1, 9)], "node_id long, confidence int")).collect()
    with pytest.raises(Exception, match="linked node 2"):
        mutate.delete_unlinked(n, n.where("node_id = 2"), spark.createDataFrame([(2,)], "node_id long")).collect()
    with pytest.raises(ValueError):
        readers.box_in_nm(((0, 0, 0), (1, 1, 1)), "INCH")
    with pytest.raises(ValueError):
        annotations.select_entities(n, n, kinds=("thing",))


def test_small_columns(spark):
    row = spark.range(1).select(annotations.map_nested(F.array(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("z"))), F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))).alias("m"), annotations.flatten(F.array(F.array(F.lit(1)), F.array(F.lit(2), F.lit(3)))).alias("f")).first()
    assert row["m"] == [[1, 2], [None]] and row["f"] == [1, 2, 3]
    page = readers.page_of_box(spark.range(5).selectExpr("'node' AS kind", "id"), 3).collect()
    assert [r["id"] for r in page] == [0, 1, 2] and all(r["more"] for r in page)
