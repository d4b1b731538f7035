from arborlake.operators import neurons

NODES = "node_id long, parent_id long, radius double, neuron string"


def tree(spark):
    return spark.createDataFrame([(1, None, 600.0, "a"), (2, 1, 1.0, "a"), (3, 2, 1.0, "a"), (4, 2, 700.0, "a"), (5, 4, 1.0, "a")], NODES)


def tags(spark, *rows):
    return spark.createDataFrame(list(rows), "node_id long, tag string")


def ids(df, column="node_id"):
    return sorted(r[column] for r in df.collect())


def test_open_ends(spark):
    assert ids(neurons.open_ends(tree(spark), tags(spark, (5, "ends"), (3, "todo")))) == [3]
    assert ids(neurons.open_ends(tree(spark), tags(spark, (None, "ends"), (3, None)))) == [3, 5]


def test_somas_need_radius_and_tag(spark):
    t = tags(spark, (1, "soma"), (1, "soma"), (2, "soma"))
    assert ids(neurons.somas(tree(spark), t)) == [1]
    assert ids(neurons.somas(tree(spark), t, 1000.0)) == [1, 2]


def test_gap_junctions(spark):
    links = spark.createDataFrame([(1, "gapjunction_with"), (2, "2"), (3, "presynaptic_to"), (4, None)], "connector_id long, relation string")
    assert ids(neurons.gap_junctions(links), "connector_id") == [1, 2]


def test_summary(spark):
    contacts = spark.createDataFrame([(3,), (3,), (9,)], "node_id long")
    assert [tuple(r) for r in neurons.summary(tree(spark), contacts, "neuron").collect()] == [("a", 5, 2, 1, 2)]
    assert neurons.summary(tree(spark).limit(0), contacts, "neuron").count() == 0


def test_remove_duplicates(spark):
    df = spark.createDataFrame([(2, "x"), (1, "x"), (3, "y"), (4, None), (5, None)], "id long, name string")
    assert ids(neurons.remove_duplicates(df, ["name"], ["id"]), "id") == [1, 3, 4]


def test_links_and_tags(spark):
    connectors = spark.createDataFrame([(10, 1), (11, 2)], "connector_id long, pre long")
    links = spark.createDataFrame([(10, 2), (10, 2), (11, 3)], "connector_id long, post long")
    wanted = spark.createDataFrame([(2,), (2,)], "id long")
    got = sorted(tuple(r) for r in neurons.connector_links(connectors, links, wanted).collect())
    assert got == [(10, 2, "postsynaptic_to"), (10, 2, "postsynaptic_to"), (11, 2, "presynaptic_to")]
    t = spark.createDataFrame([(11, "a"), (10, "a"), (10, "a")], "connector_id long, tag string")
    assert [tuple(r) for r in neurons.connector_tags(t).collect()] == [("a", [10, 11])]
    used = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "user_id long, annotation string")
    assert {tuple(r) for r in neurons.user_annotations(used).collect()} == {(1, "a", 2), (2, "a", 1)}
