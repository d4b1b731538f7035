"""Neurons as they were, unions of several neurons, and a network watched on a stream."""

import random

import pytest
from pyspark.sql import functions as F

from arborlake.operators import history, trees, unions
from arborlake.plans import past
from arborlake.streaming import live

VERSIONS = "skeleton_id long, node_id long, parent_id long, x double, created int, modified int"
NODES = "node_id long, parent_id long, skeleton_id long, x double, y double, z double"


def brute_past(rows, at):
    """The rules, neuron by neuron."""
    out = {}
    for s in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == s and r[4] != r[5]]
        now = {}
        for r in sorted(own, key=lambda r: r[4]):
            if r[4] <= at and (r[5] >= at or r[4] > r[5]):
                now[r[1]] = r[2]
        now = {i: p if p in now else None for i, p in now.items()}

        def top(i):
            while now[i] is not None:
                i = now[i]
            return i

        pieces = {}
        for i in now:
            pieces.setdefault(top(i), []).append(i)
        real = []
        for r in pieces:
            later = sorted((v[4], v[2]) for v in own if v[1] == r and (v[5] > at or v[4] > v[5]))
            if not later or later[0][1] is None:
                real.append(r)
        if pieces:
            keep = real[0] if len(real) == 1 else min(pieces, key=lambda r: (-len(pieces[r]), r))
            out |= {(s, i): now[i] for i in pieces[keep]}
    return out


def versions(seed=4):
    r, rows = random.Random(seed), []
    for s in range(30):
        for j in range(r.randrange(1, 14)):
            i, parent = 100 * s + j, 100 * s + r.randrange(j) if j else None
            start = r.randrange(1, 12)
            stop = start + r.randrange(0, 9)
            rows.append((s, i, parent if r.random() < 0.7 else None, float(j), start, stop))
            if r.random() < 0.8:
                rows.append((s, i, parent if r.random() < 0.8 else None, float(j), stop, r.choice((0, stop - 1, stop + 5))))
    return rows


def test_nodes_as_they_were(spark):
    rows = versions()
    df = spark.createDataFrame(rows, VERSIONS).repartition(3)
    for at in (0, 3, 8, 15, 99):
        got = history.nodes_at(df, F.lit(at)).collect()
        assert {(x["skeleton_id"], x["node_id"]): x["parent_id"] for x in got} == brute_past(rows, at)
    assert history.nodes_at(df.limit(0), F.lit(3)).collect() == []


def test_pieces_joined_later_are_left_out(spark):
    rows = [(1, 1, None, 0.0, 1, 0), (1, 2, 1, 0.0, 1, 0), (1, 3, None, 0.0, 2, 6), (1, 3, 2, 0.0, 6, 5), (1, 4, 3, 0.0, 2, 1), (1, 5, 4, 0.0, 2, 1), (1, 6, 3, 0.0, 4, 4)]
    df = spark.createDataFrame(rows, VERSIONS)
    # 3 is a root in its own version, so two roots are real and the larger piece stays; once it lasts, it's a child
    assert {x["node_id"] for x in history.nodes_at(df, F.lit(5)).collect()} == {3, 4, 5}
    assert {x["node_id"] for x in history.nodes_at(df, F.lit(6)).collect()} == {1, 2, 3, 4, 5}
    links = spark.createDataFrame([(10, 3, 4), (11, 4, 9), (12, 2, 1)], "connector_id long, node_id long, created int")
    seen = spark.createDataFrame([(10, 3, 1.0, 2, 1), (11, 4, 1.0, 2, 1), (12, 2, 1.0, 2, 1), (10, 3, 2.0, 1, 2), (13, 3, 0.0, 1, 0)], "connector_id long, node_id long, x double, created int, modified int")
    tags = spark.createDataFrame([(3, "a", 5), (3, "b", 6), (1, "c", None)], "node_id long, tag string, created int")
    past = history.rewind(F.lit(5), df, seen, links, tags, tags)
    assert set(past) == {"nodes", "connectors", "tags", "annotations"} and {tuple(x) for x in past["connectors"].collect()} == {(10, 3, 1.0)}
    assert {x["tag"] for x in past["tags"].collect()} == {"a"}
    with pytest.raises(ValueError):
        history.rewind(F.lit(5), df, seen)


def one_tree(rows):
    up = {x["node_id"]: x["parent_id"] for x in rows}
    assert len(up) == len(rows) and sum(p is None for p in up.values()) == 1
    for i in up:
        seen = set()
        while i is not None:
            assert i not in seen
            seen.add(i)
            i = up[i]
    return up


def copies(spark, n=4, seed=1):
    """Neurons that share a backbone, each with a piece of its own; later ones run the other way round."""
    r, rows = random.Random(seed), []
    for s in range(n):
        line = list(range(20))
        order = line if s % 2 == 0 else line[::-1]
        for k, i in enumerate(order):
            rows.append((1000 * s + i, 1000 * s + order[k - 1] if k else None, s + 7, float(i), 0.1 * s if s < 3 or i < 5 else 50.0 + i, r.random() * 0.01))
        rows += [(1000 * s + 100 + i, 1000 * s + (100 + i - 1 if i else 10), s + 7, 10.0, 5.0 + i + s * 3, 30.0 * s) for i in range(6)]
    return spark.createDataFrame(rows, NODES), rows


def test_union_of_many(spark):
    df, rows = copies(spark)
    tags = spark.createDataFrame([(0, "t"), (1000, "t"), (2000, "u"), (3100, "v")], "node_id long, tag string")
    links = spark.createDataFrame([(1, 1003), (2, 3), (3, 3019), (4, 2105)], "connector_id long, node_id long")
    got = unions.union_all(df, 0.35, connectors=links, tags=tags)
    into = {x["node_id"]: x["into"] for x in got["merged"].collect()}
    up = one_tree(got["nodes"].collect())
    assert {x["skeleton_id"] for x in got["nodes"].collect()} == {7}
    assert set(up) == {r[0] for r in rows} - set(into) and all(into[1000 * s + i] == i for s in (1, 2) for i in range(20)) and {3000 + i for i in range(5)} <= set(into)
    # the base keeps its links and its root
    assert all(up[r[0]] == r[1] for r in rows if r[2] == 7)
    # no link is new but for what nodes went into
    old = {frozenset((into.get(r[0], r[0]), into.get(r[1], r[1]))) for r in rows if r[1] is not None}
    assert all(frozenset((i, p)) in old for i, p in up.items() if p is not None)
    assert {tuple(x) for x in got["tags"].collect()} == {(0, "t"), (0, "u"), (3100, "v")}
    assert {tuple(x) for x in got["connectors"].collect()} == {(1, 3), (2, 3), (3, 3019), (4, 2105)}
    other = unions.union_all(df, 0.35, base=9)
    up = one_tree(other["nodes"].collect())
    assert all(up[r[0]] == r[1] for r in rows if r[2] == 9)


def test_union_without_overlap(spark):
    rows = [(1, None, 1, 0.0, 0.0, 0.0), (2, 1, 1, 1.0, 0.0, 0.0), (10, None, 2, 1.05, 0.0, 0.0), (11, 10, 2, 2.0, 0.0, 0.0), (20, None, 3, 50.0, 0.0, 0.0), (21, 20, 3, 60.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, NODES)
    with pytest.raises(ValueError, match="3"):
        unions.union_all(df, 0.1)
    skip = unions.union_all(df, 0.1, non_overlap="skip", tags=spark.createDataFrame([(20, "x"), (10, "y")], "node_id long, tag string"))
    assert {x["node_id"]: x["parent_id"] for x in skip["nodes"].collect()} == {1: None, 2: 1, 11: 2} and [tuple(x) for x in skip["tags"].collect()] == [(2, "y")]
    stitch = {x["node_id"]: x["parent_id"] for x in unions.union_all(df, 0.1, non_overlap="stitch")["nodes"].collect()}
    assert stitch == {1: None, 2: 1, 11: 2, 20: 11, 21: 20}
    for bad in ({"non_overlap": "hope"}, {"base": 99}):
        with pytest.raises(ValueError):
            unions.union_all(df, 0.1, **bad)


def test_long_ways_up(spark):
    """Ancestors over more bits of depth than a plan could hold as copies of itself."""
    chain = spark.createDataFrame([(i, i - 1 if i else None, 1, 0.0, 0.0, float(i)) for i in range(700)], NODES)
    way = trees.ancestors(chain, spark.createDataFrame([(699,), (5,)], "node_id long")).collect()
    assert sorted((x["node_id"], x["hops"], x["ancestor"]) for x in way) == [(5, k, 5 - k) for k in range(6)] + [(699, k, 699 - k) for k in range(700)]
    ring = spark.createDataFrame([(1, 2), (2, 1), (3, 1)], "node_id long, parent_id long")
    with pytest.raises(ValueError):
        trees.to_root(ring, F.lit(0.0))


def test_watched_network_goes_on_after_a_restart(spark, tmp_path):
    """Changes per batch over three batches with a restart after each, and the edges that they add up to."""
    batches = [[(1, 2, 1), (1, 2, 1), (3, 4, 1), (None, 4, 1)], [(1, 2, 1), (3, 4, -1), (5, 6, 1), (5, 6, 1), (9, 9, None)], [(1, 2, -3), (5, 6, -1), (3, 4, 2), (7, 8, 1), (7, 8, -1)]]
    kind = "source long, target long, delta long"
    want = [{(1, 2, "new", 2)}, {(1, 2, "changed", 3), (5, 6, "new", 2)}, {(1, 2, "gone", None), (5, 6, "gone", None), (3, 4, "new", 2)}]
    edges, least = {}, 2
    for k, (rows, changes) in enumerate(zip(batches, want)):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        seen = []
        stream = live.watch_network(spark.readStream.schema(kind).parquet(f"{tmp_path}/in"), least)
        query = stream.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/state").foreachBatch(lambda df, i, seen=seen: seen.extend(df.collect())).start()
        query.awaitTermination(120)
        assert {tuple(x) for x in seen} == changes and len(seen) == len(changes)
        for x in seen:
            edges[x["source"], x["target"]] = x["weight"]
    every = spark.createDataFrame([r for b in batches for r in b], kind).where("delta IS NOT NULL AND source IS NOT NULL")
    batch = {(x["source"], x["target"]): x["w"] for x in every.groupBy("source", "target").agg(F.sum("delta").alias("w")).where(F.col("w") >= least).collect()}
    assert {k: w for k, w in edges.items() if w is not None} == batch == {(3, 4): 2}


def test_union_of_more_parts_than_a_copy_has_ids_for(spark, tmp_path):
    ids = sorted({1_000_005 >> k for k in range(21)} | set(range(12)))
    spark.createDataFrame([(i, i % 50 + 1, 900.0 + i) for i in ids], "p_partkey long, p_size int, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(n, i, n % 7, "R") for n, i in enumerate(ids)], "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    off = lambda i, k: (k == 1 and i % 4 == 1) or (k == 2 and i % 5 == 2)
    name = lambda i, k: i + k * 1_000_000 if off(i, k) else i
    want = sorted((i + k * 1_000_000, name(i // 2, k) if i else -1, 0) for i in ids for k in range(3) if not k or off(i, k))
    out = past._united(spark, str(tmp_path))
    got = sorted((r["node_id"], -1 if r["parent_id"] is None else r["parent_id"], r["skeleton_id"]) for r in out["nodes"].collect())
    assert got == want
    assert sorted(tuple(r) for r in out["connectors"].collect()) == sorted((n, name(i, n % 7 % 3)) for n, i in enumerate(ids))


def test_queries_of_unions_join_by_names_beyond_a_million_parts(spark, tmp_path):
    """Nodes of two copies bear one name there; the queries have the rows of their SQL all the same."""
    import duckdb

    ids = sorted({x >> k for x in (1_000_005, 1_000_009, 1_000_012, 1_500_003, 2_000_007) for k in range(22)} | set(range(14)))
    spark.createDataFrame([(i, i % 50 + 1, 900.0 + i) for i in ids], "p_partkey long, p_size int, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(n, i, j, "RA"[n % 2]) for n, i in enumerate(ids) for j in range(3)], "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    for q in ("union_all", "union_all_connectors", "union_all_tags"):
        out = past.QUERIES[q](spark, str(tmp_path))
        want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({past.SQL[q]})").fetchall()
        key = lambda r: [(x is None, x) for x in r]
        assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
