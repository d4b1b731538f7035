"""What came out wrong, or grew too fast, on larger tables."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from arborlake.functions import text
from arborlake.operators import clustering, connectivity, trees
from arborlake.plans import registry


def test_broken_slices_of_a_long_stack(spark, tmp_path):
    rows = [(k, 0) for k in (2, 3, 10_002, 10_003, 59_998, 59_999)]
    spark.createDataFrame(rows, "s_suppkey long, s_nationkey int").write.parquet(str(tmp_path / "supplier.parquet"))
    got = {tuple(r) for r in registry.QUERIES["resolve_broken_slices"](spark, str(tmp_path)).collect()}
    assert got == {(k, k // 4 * 4 + 1) for k, _ in rows}
    # a stack that ends has no replacement behind its end
    broken = spark.createDataFrame([(3, 1), (7, 1)], "slice long, step int")
    assert {tuple(r) for r in text.whole_slices(broken, 5).collect()} == {(3, 4)}


def exact_kurtosis(values):
    n, mean = len(values), Fraction(sum(values), len(values))
    second = sum((v - mean) ** 2 for v in values) / n
    return float(sum((v - mean) ** 4 for v in values) / n / second**2 - 3) if second else None


def test_kurtosis_of_whole_numbers_is_rounded_once(spark):
    r = random.Random(5)
    rows = {k: [r.choice([1, 1, 1, 1, 2, 2, 3, 9]) for _ in range(r.randrange(2, 400))] for k in range(200)} | {500: [4], 501: [3] * 49}
    df = spark.createDataFrame([(k, v) for k, own in rows.items() for v in own], "target long, weight long")
    got = {x["target"]: x["sparseness"] for x in connectivity.sparseness(df, which="LTK").collect()}
    want = {k: exact_kurtosis(own) for k, own in rows.items()}
    assert {k for k, v in want.items() if v is None} == {k for k, v in got.items() if v is None}
    assert max(abs(got[k] - v) / max(abs(v), 1e-9) for k, v in want.items() if v is not None) < 5e-16
    # beyond the range of exact sums
    large = spark.createDataFrame([(0, v) for v in (10**12, 3 * 10**12, 10**13)], "target long, weight long")
    assert abs(connectivity.sparseness(large, which="LTK").first()["sparseness"] + 1.5) < 1e-9


@pytest.mark.parametrize("how", [{}, {"syn_cutoff": 3, "syn_threshold": 2}, {"syn_threshold": 0}, {"fractions": True}])
def test_grid_of_adjacency_is_not_shuffled(spark, monkeypatch, how):
    monkeypatch.setattr(connectivity, "LISTED", 4)
    r = random.Random(6)
    edges = {(r.randrange(20), r.randrange(15)): r.randrange(1, 6) for _ in range(90)}
    df = spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "source long, target long, weight long")
    out = connectivity.adjacency(df, spark.range(0, 25, 2), spark.range(1, 18), **how)
    total = {b: sum(w for (_, t), w in edges.items() if t == b) for b in range(18)}

    def want(a, b):
        w = float(min(edges.get((a, b), 0), how.get("syn_cutoff", 99)))
        w = 0.0 if w < how.get("syn_threshold", 0) else w
        return (w / total[b] if total[b] else None) if how.get("fractions") else w

    got = out.collect()
    assert len(got) == 13 * 17 and {(x["source"], x["target"]): x["weight"] for x in got} == {(a, b): want(a, b) for a in range(0, 25, 2) for b in range(1, 18)}
    # nothing is dealt anew after the grid is unfolded
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and "Exchange" not in plan[: plan.index("Generate explode")]


def test_rounds_over_trees_send_no_nodes_to_the_driver(spark, monkeypatch):
    plans = []
    cut = trees.cut
    monkeypatch.setattr(trees, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    n = cut(spark.range(40).select(F.col("id").alias("node_id"), F.expr("CASE WHEN id > 0 THEN id div 2 END").alias("parent_id"), *[F.col("id").cast("double").alias(c) for c in "xyz"]))
    order = trees.strahler(n)
    far = trees.geodesic(n, n.select(F.col("node_id").alias("a"), F.pmod(F.col("node_id") * 7 + 3, F.lit(40)).alias("b")))
    plans += [df._jdf.queryExecution().executedPlan().toString() for df in (order, far, trees.prune_by_strahler(n, [1, -1]), trees.with_length(n))]
    assert len(plans) > 8 and [p for p in plans if "Broadcast" in p] == []
    assert {r["node_id"] for r in order.where("strahler = 1").collect()} == set(range(20, 40))


def whole_tree(items, distance, height):
    """Clusters by the whole tree of merges, named by their smallest items."""
    left, name = set(items), {}
    while left:
        part, front = set(), {min(left)}
        while front:
            part |= front
            front = {b for a in front for b in left - part if distance(a, b) <= height}
        name |= dict.fromkeys(part, min(part))
        left -= part
    return name


def test_clusters_on_a_line_make_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(clustering, "STRETCHES", 5)
    monkeypatch.setattr(clustering, "merges", lambda *_: pytest.fail("a table of pairs"))
    r = random.Random(8)
    at = {k: r.choice([0.0, 1.0, round(r.uniform(0, 60), 2)]) for k in r.sample(range(500), 80)}
    got = clustering.cut_on_a_line(spark.createDataFrame(list(at.items()) + [(900, None)], "id long, v double"), 1.5)
    assert {x["id"]: x["cluster"] for x in got.collect()} == whole_tree(at, lambda a, b: abs(at[a] - at[b]), 1.5) | {900: 900}
    assert [tuple(x) for x in clustering.cut_on_a_line(spark.createDataFrame([(4, 1.0)], "id long, v double"), 1.5).collect()] == [(4, 4)]


def test_single_clusters_need_no_tree(spark, monkeypatch):
    r = random.Random(9)
    pairs = {(a, b): r.choice([0.2, 0.5, 0.9, 0.9, 0.9, 0.9, 0.9, 0.9]) for a in range(25) for b in range(a)}
    df = spark.createDataFrame([(a, b, d) for (a, b), d in pairs.items()] + [(b, a, d) for (a, b), d in pairs.items()] + [(a, a, 0.0) for a in range(25)], "a long, b long, distance double")
    height = 0.2
    tree = {tuple(x) for x in clustering.cut_by_distance(clustering.dendrogram(df, "single"), height).collect()}
    monkeypatch.setattr(clustering, "merges", lambda *_: pytest.fail("merges one after the other"))
    got = clustering.cut_single(df, height).collect()
    assert {tuple(x) for x in got} == tree == set(whole_tree(range(25), lambda a, b: pairs[max(a, b), min(a, b)] if a != b else 0, height).items()) and len(got) == 25


def test_sums_below_take_as_many_rounds_as_the_depth_has_bits(spark, monkeypatch):
    r = random.Random(8)
    up = {i: (i - 1) // 2 if i < 255 else r.choice([i - 1, r.randrange(i)]) for i in range(1, 400)} | {0: None, 1000: None, 1001: 1000}
    value = {i: float(i % 13) for i in up}
    nodes = spark.createDataFrame([(i, p, value[i]) for i, p in up.items()], "node_id long, parent_id long, v double")
    written = []
    cut = trees.cut
    monkeypatch.setattr(trees, "cut", lambda df: written.append(1) or cut(df))
    got = {x["node_id"]: x["v"] for x in trees.sum_below(nodes, ["v"]).collect()}
    want, depth = dict.fromkeys(up, 0.0), 0
    for i in up:
        at, steps = i, 0
        while at is not None:
            want[at] += value[i]
            at, steps = up[at], steps + 1
        depth = max(depth, steps)
    assert got == want and len(written) == (depth - 1).bit_length()
    ring = spark.createDataFrame([(1, 2, 1.0), (2, 1, 1.0)], "node_id long, parent_id long, v double")
    with pytest.raises(ValueError, match="ring"):
        trees.sum_below(ring, ["v"])


def test_words_of_a_name_are_told_apart_once(spark):
    df = spark.createDataFrame([("a b neuron 77 kc JJ PS",), (None,), ("plain",)], "name string")
    for out in (df.select(text.parse_name(F.col("name")).alias("n")).select("n.*"), df.select(text.shorten_name(F.col("name"), 12))):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("split(name#") == 1
    assert df.select(text.parse_name(F.col("name")).alias("n")).select("n.*").collect()[0] == ("a b", "kc", "JJ PS", "neuron 77")


def test_nearest_within_a_wide_reach_pairs_near_points_only(spark, monkeypatch):
    from arborlake.operators import spatial

    monkeypatch.setattr(spatial, "CROWD", 3)
    r = random.Random(4)
    at = [(i, i % 3, i % 2, *(r.choice([r.gauss(0, 1), float(r.randrange(3))]) for _ in "xyz")) for i in range(240)]
    at += [(i + 1000, *at[i][1:]) for i in range(20)] + [(2000, 0, 0, 40.0, 0.0, 0.0), (2001, 1, 0, 49.0, 0.0, 0.0), (2002, 2, 0, None, 0.0, 0.0)]
    df = spark.createDataFrame(at, "point_id long, neuron int, kind int, x double, y double, z double")
    levels = []
    cells = spatial.cells
    monkeypatch.setattr(spatial, "cells", lambda df, size, around=False: (around and levels.append(size)) or cells(df, size, around))
    got = {(x["point_id"], x["b"]): (x["d"], x["n"]) for x in spatial._nearest_within(df, 10.0).collect()}
    far = lambda p, q: ((p[3] - q[3]) ** 2 + (p[4] - q[4]) ** 2 + (p[5] - q[5]) ** 2) ** 0.5
    known = [p for p in at if p[3] is not None]
    want = {(p[0], b): min(near) for p in known for b in range(3) if (near := [(d, q[0]) for q in known if q[1] == b and q[2] == p[2] and (d := far(p, q)) <= 10])}
    assert got.keys() == want.keys() and all(got[k][1] == n and abs(got[k][0] - d) < 1e-12 for k, (d, n) in want.items())
    assert got[2000, 1] == (9.0, 2001) and len(levels) > 3 and min(levels) < 1 and levels[-1] == 10


def test_links_are_dealt_to_places_that_grow_with_them(spark, monkeypatch, tmp_path):
    from arborlake.plans import network

    spark.range(300).selectExpr("id AS o_orderkey", "id % 40 AS o_custkey", "current_date() AS o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(900).selectExpr("id % 300 AS l_orderkey", "id % 17 AS l_suppkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber").write.parquet(str(tmp_path / "lineitem.parquet"))
    queries = (network.edge_table, registry.QUERIES["network_changes"], registry.QUERIES["connectivity_counts_links"])
    plain = [sorted(map(tuple, q(spark, str(tmp_path)).collect())) for q in queries]
    monkeypatch.setattr(connectivity, "DEALT", 70)
    assert plain == [sorted(map(tuple, q(spark, str(tmp_path)).collect())) for q in queries]
    assert network.edge_table(spark, str(tmp_path)).rdd.getNumPartitions() == 13


def test_similarity_and_fragments_are_dealt_to_places_that_grow(spark, monkeypatch):
    from arborlake.operators import connectors, similarity

    links = spark.createDataFrame([(i % 23, i % 9 + 1, ("presynaptic_to", "postsynaptic_to")[i % 3 > 0]) for i in range(120)], "connector_id long, fragment_id long, relation string")
    edges = spark.createDataFrame([(i % 12, i * i % 7 + 20, i % 4 + 1) for i in range(84)], "source long, target long, weight long").dropDuplicates(["source", "target"])
    some = spark.createDataFrame([(0,), (5,), (7,)], "id long")

    def every():
        sim = similarity.neuron_similarity(similarity.partner_weights(edges), some, parts=2)
        whole = similarity.neuron_similarity(similarity.partner_weights(edges), some, some, parts=2, complete=True)
        to = connectivity.similarity_to(edges, some, parts=2)
        part = connectors.partners_from_connectors(links, links.where("fragment_id < 4"), parts=connectivity.places(spark, 120))
        return [sim, whole, to, part]

    shown = lambda frames: [sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in x) for x in df.collect()) for df in frames]
    plain = shown(every())
    assert all(plain)
    monkeypatch.setattr(connectivity, "DEALT", 6)
    dealt = every()
    assert plain == shown(dealt)
    # four places are the session's
    assert all(df.rdd.getNumPartitions() > 4 for df in dealt)


def test_pairs_of_a_similarity_are_not_shuffled(spark, monkeypatch):
    """Lists of a query's neurons are dealt, and unfolded where their pairs are summed; a partner of many has several lists."""
    from arborlake.operators import similarity

    edges = spark.createDataFrame([(i, j, (i * j) % 4 + 1) for i in range(30) for j in (50, 51 + i % 3, 60 + i % 7)], "source long, target long, weight long")
    some, weights = spark.range(0, 30, 2), similarity.partner_weights(edges)
    every = lambda: [similarity.neuron_similarity(weights, some), connectivity.similarity_to(edges, some)]
    shown = lambda frames: [sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in x) for x in df.collect()) for df in frames]
    plain = shown(every())
    assert {(a, b) for a, b, *_ in plain[1]} == {(a, b) for a in range(0, 30, 2) for b in range(30)}
    monkeypatch.setattr(connectivity, "TOGETHER", 2)
    for k in (1 << 17, 3):
        monkeypatch.setattr(connectivity, "FEW", k)
        frames = every()
        assert plain == shown(frames)
        for df in frames if k > 3 else ():
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan[: plan.index("Generate inline")].replace("BroadcastExchange", "")


def test_single_clusters_of_similar_make_no_other_pairs(spark):
    """As from the whole matrix of distances, where pairs that are left out have a similarity of 0."""
    r = random.Random(8)
    sim = {(a, b): r.random() for a in range(20) for b in range(a) if r.random() < 0.12}
    items = spark.range(22)
    for scale, height in ((1.0, 0.3), (1.0, 0.6), (0.5, 0.7)):
        rows = [(a, b, s * scale) for (a, b), s in sim.items()] + [(b, a, s * scale) for (a, b), s in sim.items()]
        top = max(s for *_, s in rows)
        whole = [(a, b, top - scale * sim.get((a, b), 0.0)) for a in range(22) for b in range(a)]
        want = clustering.cut_single(spark.createDataFrame(whole, "a long, b long, distance double"), height).collect()
        got = clustering.cut_single_of_similar(spark.createDataFrame(rows, "a long, b long, similarity double"), items, height).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 22
