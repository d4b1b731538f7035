"""Registered queries see whole tables."""

import pytest

from arborlake.operators import search
from arborlake.plans import network, searching, shapes

ROWS = 500


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = f"file://{tmp_path_factory.mktemp('lake')}"
    tables = {
        "part": spark.range(ROWS).selectExpr("id AS p_partkey", "CAST(id % 50 + 1 AS INT) AS p_size", "900D + id AS p_retailprice"),
        "customer": spark.range(ROWS).selectExpr("id AS c_custkey"),
        "orders": spark.range(ROWS).selectExpr("id AS o_orderkey", "id AS o_custkey", "current_date() AS o_orderdate"),
        "lineitem": spark.range(ROWS).selectExpr("id AS l_orderkey", "id % 7 AS l_suppkey", "1 AS l_linenumber"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{d}/{name}.parquet")
    return d


def test_all_nodes(spark, folder):
    assert shapes.QUERIES["virtual_nodes"](spark, folder).agg({"node_id": "max"}).first()[0] == ROWS - 1
    assert shapes.QUERIES["image_tiles"](spark, folder).agg({"box_id": "max"}).first()[0] == ROWS - 1
    far = {r["a"]: (r["b"], r["distance"]) for r in shapes.QUERIES["geodesic_segments"](spark, folder).collect()}
    assert set(far) == set(range(1, ROWS)) and all((d == 0) == (a == b) for a, (b, d) in far.items())


def test_density_of_all_contacts(spark, folder):
    xyz = {i: (i % 50 + 1, 900 + i, i) for i in range(ROWS)}

    def up(i):
        out, d = {i: 0.0}, 0.0
        while i:
            d += sum((a - b) ** 2 for a, b in zip(xyz[i], xyz[i // 2])) ** 0.5
            out[i := i // 2] = d
        return out

    ups = [up(i) for i in range(ROWS)]
    for r in shapes.QUERIES["connection_density"](spark, folder).collect():
        own = range(r["grp"], ROWS, 7)
        d = sorted(min(ups[a][k] + ups[b][k] for k in ups[a].keys() & ups[b].keys()) for a in own for b in own if a < b)
        median = (d[len(d) // 2] + d[(len(d) - 1) // 2]) / 2
        assert abs(r["density"] - 1000 / median) < 2e-6


def test_partners_of_all_neurons(spark, folder):
    assert sorted(r["query"] for r in network.QUERIES["get_partners_all"](spark, folder).collect()) == list(range(ROWS))


def test_closure_has_no_depth(spark, folder):
    chain = spark.createDataFrame([(str(i), str(i + 1)) for i in range(13)] + [("13", "3")], "parent string, child string")
    start = spark.createDataFrame([("0",)], "annotation string")
    assert {r["annotation"]: r["level"] for r in search.sub_annotations(chain, start).collect()} == {str(i): i for i in range(14)}
    assert search.sub_annotations(chain, start, 2).count() == 3
    assert searching.QUERIES["sub_annotations_all"](spark, folder).count() == ROWS
