"""The link fixture: A, B and C are presynaptic, X, Y and Z postsynaptic."""

import pytest

from arborlake.operators import connectivity as c

ROWS = [(1, "A", "X", 5), (1, "A", "Y", 3), (2, "A", "X", 4), (2, "A", "X", 5), (3, "B", "X", 2), (3, "B", "Z", 5), (4, "B", "Y", 5), (5, "C", "Z", 1)]


@pytest.fixture(scope="module")
def tables(spark):
    pre = spark.createDataFrame(sorted({(k, a) for k, a, _, _ in ROWS}), "connector_id long, pre string")
    return pre, spark.createDataFrame([(k, b, n) for k, _, b, n in ROWS], "connector_id long, post string, confidence int")


def ids(spark, text):
    return spark.createDataFrame([(x,) for x in text], "id string")


def matrix(df):
    return {(r["source"], r["target"]): r["weight"] for r in df.collect()}


def test_adjacency(spark, tables):
    got = matrix(c.adjacency(c.edges(*tables), ids(spark, "ABC"), ids(spark, "XYZ")))
    assert got == {("A", "X"): 3, ("A", "Y"): 1, ("A", "Z"): 0, ("B", "X"): 1, ("B", "Y"): 1, ("B", "Z"): 1, ("C", "X"): 0, ("C", "Y"): 0, ("C", "Z"): 1}


def test_confidence_cutoff_threshold(spark, tables):
    grid = lambda e, **k: matrix(c.adjacency(e, ids(spark, "ABC"), ids(spark, "XYZ"), **k))
    four = grid(c.edges(*tables, min_confidence=4))
    assert (four["A", "X"], four["A", "Y"], four["B", "Y"], four["B", "Z"], four["C", "Z"]) == (3, 0, 1, 1, 0)
    assert c.edges(*tables, min_confidence=0).count() == c.edges(*tables).count()
    e = c.edges(*tables)
    assert grid(e, syn_cutoff=2)["A", "X"] == 2
    assert [k for k, v in grid(e, syn_threshold=2).items() if v] == [("A", "X")]


def test_fractions(spark, tables):
    got = matrix(c.adjacency(c.edges(*tables), ids(spark, "ABC"), ids(spark, "XYZ") .union(ids(spark, "Q")), fractions=True))
    assert (got["A", "X"], got["B", "X"], got["B", "Z"], got["A", "Q"]) == (0.75, 0.25, 0.5, None)


def test_sparseness(spark, tables):
    grid = c.adjacency(c.edges(*tables), ids(spark, "ABC"), ids(spark, "XYZ"))
    got = {r[0]: round(r[1], 6) for r in c.sparseness(grid).collect()}
    assert got == {"X": 0.7, "Y": 0.5, "Z": 0.5}
    assert {round(r[1], 6) for r in c.sparseness(grid, which="LTK").collect()} == {-1.5}


def test_similarity(spark, tables):
    got = {(r["a"], r["b"]): [round(r[i], 6) for i in range(2, 7)] for r in c.similarity(c.edges(*tables), ids(spark, "ABC")).collect()}
    assert got["A", "A"] == [1, 1, 1, 3.741380, 1]
    assert got["A", "B"] == [0.666667, 0.857143, 0.666667, 0.764241, 0.462525]
    assert got["A", "C"] == [0, 0, 0, -2.5, 0]
    assert got["B", "C"] == [0.333333, 0.5, 0.333333, -0.183940, 0.333333]
    assert got["A", "B"] == got["B", "A"]


def test_grouping_is_rows_first(spark, tables):
    groups = spark.createDataFrame([("A", "g"), ("B", "g")], "id string, grp string")
    got = matrix(c.group_matrix(c.adjacency(c.edges(*tables), ids(spark, "ABC"), ids(spark, "XYZ")), groups, None, "AVERAGE"))
    assert got["g", "X"] == 2 and got["C", "Z"] == 1
    assert {k[0] for k in matrix(c.group_matrix(c.edges(*tables), groups, drop_ungrouped=True))} == {"g"}


def test_hops_and_paths(spark):
    e = spark.createDataFrame([(1, 2, 5), (2, 3, 5), (3, 1, 5), (1, 3, 1)], "source long, target long, weight long")
    one = spark.createDataFrame([(1,)], "id long")
    got = {(r["id"], r["hop"]) for r in c.nth_partners(e, one, 2, min_pre=-1, min_post=2).collect()}
    assert got == {(1, 0), (2, 1), (3, 2)}
    three = spark.createDataFrame([(3,)], "id long")
    assert sorted((r["path"], r["hops"]) for r in c.paths(e, one, three, [1, 2]).collect()) == [([1, 2, 3], 2), ([1, 3], 1)]
