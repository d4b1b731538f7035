import datetime as dt

import numpy as np
import pytest

from arborlake.functions import text
from arborlake.operators import activity, clustering, mutate, search, spatial
from arborlake.streaming import live

from . import linkage


def rows(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize("query, partial", [("spade", False), ("~spade", False), ("annotation:spade", False), ("/sp.*e", False), ("annotation:/sp.*e", False), ("ad", True), (" spade ", False)])
def test_names(spark, query, partial):
    names = spark.createDataFrame([(x,) for x in ("potato", "spade", "orange", "bears")], "name string")
    assert rows(search.filter_by_query(names, "name", query, partial), "name") == {("spade",)}


def test_star_is_literal(spark):
    names = spark.createDataFrame([("*spade",), ("spade",)], "name string")
    assert rows(search.filter_by_query(names, "name", "*spade"), "name") == {("*spade",)}


def test_users(spark):
    users = spark.createDataFrame([(1, "ann", "Lee", "Ann Lee", "Ann"), (2, "bob", "Lee", "Bob Lee", "Bob")], "user_id long, login string, last_name string, full_name string, first_name string")
    assert rows(search.resolve_users(["ann", "Bob", "Lee", "nobody"], users), "term", "user_id") == {("ann", 1), ("Bob", 2)}


def stamp(text):
    return dt.datetime.fromisoformat(text)


ACTIONS = [("u1", "2024-01-01 00:01"), ("u1", "2024-01-01 00:05"), ("u1", "2024-01-01 00:12"), ("u1", "2024-01-02 10:00"), ("u1", "2024-01-02 10:09"), ("u2", "2024-01-02 10:10")]


def test_time_bins(spark):
    a = spark.createDataFrame([(u, stamp(x), "node") for u, x in ACTIONS], "user_id string, ts timestamp_ntz, action string")
    assert rows(activity.time_invested(a, 10, 0.2), "user_id", "minutes") == {("u1", 20)}
    days = {(r["user_id"], str(r["day"]), r["bins"]) for r in activity.bins_over_time(a, 10, 0.2).collect()}
    assert days == {("u1", "2024-01-01", 1), ("u1", "2024-01-02", 1)}
    per_day = {(r["user_id"], str(r["day"])): r["actions"] for r in activity.actions_per_day(a).collect()}
    assert per_day == {("u1", "2024-01-01"): 3, ("u1", "2024-01-02"): 2, ("u2", "2024-01-01"): 0, ("u2", "2024-01-02"): 1, ("all_groups", "2024-01-01"): 3, ("all_groups", "2024-01-02"): 3}


def test_bin_origin(spark):
    a = spark.createDataFrame([("a", stamp("2024-01-01 00:01"), "x"), ("b", stamp("2024-01-03 00:01"), "x"), ("b", stamp("2024-01-03 00:08"), "x")], "user_id string, ts timestamp_ntz, action string")
    start = lambda df: sorted(str(r["origin"] + dt.timedelta(minutes=7 * r["bin"])) for r in df.where("user_id = 'b'").collect())
    assert start(activity.bins(a, 7)) == ["2024-01-02 23:57:00", "2024-01-03 00:04:00"]
    assert start(activity.bins(a, 7, ["user_id"])) == ["2024-01-03 00:00:00", "2024-01-03 00:07:00"]


def test_synapse_placement(spark):
    p = [(1, "A", 0, 0.0, 0.0, 0.0), (2, "A", 0, 1000.0, 0.0, 0.0), (3, "A", 0, 5000.0, 0.0, 0.0), (4, "B", 0, 0.0, 0.0, 1000.0), (5, "B", 0, 5000.0, 0.0, 0.0)]
    s = spatial.synapse_similarity(spark.createDataFrame(p, "point_id long, neuron string, kind int, x double, y double, z double"))
    got = {(r["a"], r["b"]): round(r["similarity"], 6) for r in s.collect()}
    assert got["A", "B"] == 0.730124 and got["B", "A"] == 0.816168
    assert {round(r["similarity"], 6) for r in spatial.mutual(s).where("a = 'A' AND b = 'B'").collect()} == {0.773146}


def test_contact_radius(spark):
    d = spark.createDataFrame([(100.0,), (200.0,), (400.0,)], "distance double")
    assert round(spatial.contact_radius(d).first()[0], 6) == 471.428571
    assert spatial.contact_radius(d.limit(0)).first()[0] == 1000


def test_nearest_against_brute_force(spark):
    g = np.random.default_rng(1)
    a, b = g.random((80, 3)), g.random((90, 3))
    frame = lambda x: spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "point_id long, x double, y double, z double")
    d = np.linalg.norm(a[:, None] - b[None], axis=2)
    want = {(i, int(d[i].argmin())) for i in range(len(a)) if d[i].min() <= 0.2}
    assert rows(spatial.nearest(frame(a), frame(b), 0.2), "a", "b") == want


def test_linkage():
    x = np.array([0.0, 1.0, 5.0, 7.0])
    m = np.abs(x[:, None] - x[None])
    assert linkage.merge_all(m, "single")[:, 2].tolist() == [1, 2, 4]
    assert linkage.merge_all(m, "complete")[:, 2].tolist() == [1, 2, 7]
    assert linkage.merge_all(m, "average")[:, 2].tolist() == [1, 2, 5.5]
    assert linkage.cut_tree(linkage.merge_all(m, "ward"), 2).tolist() == [1, 1, 2, 2]
    merges = linkage.merge_all(m, "single")
    assert linkage.cophenetic(merges)[0, 3] == 4
    assert linkage.agglomerative_coefficient(merges) == pytest.approx((0.75 * 2 + 0.5 * 2) / 4)
    assert sorted(linkage.leaf_order(merges)) == [0, 1, 2, 3]


def test_labels(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a", "a", ["x", "y"]), ("a", None, []), (None, "b", ["z"])], "n string, m string, l array<string>")
    out = df.select(text.label("%0 %1 [%2{+}]", {"0": F.col("n"), "1": F.col("m"), "2": F.col("l")}, arrays=("2",)).alias("s"))
    assert [r["s"] for r in out.collect()] == ["a [x+y]", "a]", "b [z]"]


def test_changes(spark):
    old = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 0.0)], "node_id long, x double").selectExpr("*", "0.0D AS y", "0.0D AS z")
    new = spark.createDataFrame([(1, 0.0), (2, -1.0), (4, 0.0)], "node_id long, x double").selectExpr("*", "0.0D AS y", "0.0D AS z")
    assert rows(mutate.diff_nodes(old, new), "node_id", "state") == {(1, "mutual"), (2, "moved"), (3, "deleted"), (4, "added")}
    links = spark.createDataFrame([(1, "abutting")], "node_id long, relation string")
    with pytest.raises(Exception, match="unknown relation"):
        mutate.link_connector(links, spark.createDataFrame([(2, "near")], "node_id long, relation string")).collect()
    e = lambda *r: spark.createDataFrame(list(r), "source long, target long, weight long")
    assert rows(live.network_changes(e((1, 2, 3), (1, 3, 1)), e((1, 2, 4), (2, 3, 1))), "source", "target", "change") == {(1, 2, "changed"), (1, 3, "gone"), (2, 3, "new")}


def test_stream_equals_batch(spark, tmp_path):
    a = spark.createDataFrame([(u, stamp(x)) for u, x in ACTIONS], "user_id string, ts timestamp")
    a.write.parquet(str(tmp_path / "in"))
    stream = live.activity(spark.readStream.schema(a.schema).parquet(str(tmp_path / "in")), 10)
    q = stream.writeStream.format("memory").queryName("bins").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("bins"), "user_id", "start", "n") == rows(live.activity(a, 10), "user_id", "start", "n")


def test_registry():
    import __spark_entry__ as entry

    queries = entry.queries()
    assert len(queries) > 70 and set(entry.oracle_sql()) <= set(queries)
