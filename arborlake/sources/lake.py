"""The engine's tables as views over star-schema tables.

One order is a connector with a single presynaptic neuron (the customer); its line
items are the links to postsynaptic neurons (suppliers). Parts form a binary tree of
nodes, conversations are chains, events are user actions, embeddings are points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def connectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """connector_id, pre, created."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("connector_id"), F.col("o_custkey").alias("pre"), F.col("o_orderdate").alias("created"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """connector_id, post, confidence: a row a link, not a distinct pair."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("connector_id"), F.col("l_suppkey").alias("post"), ((F.col("l_linenumber") - 1) % 5 + 1).alias("confidence"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node_id, parent_id (null at the root), x, y, z, radius, confidence."""
    parent = F.expr("p_partkey div 2")
    # the keys begin at 0, which is the parent of 1
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node_id"), F.when(F.col("p_partkey") > 0, parent).alias("parent_id"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"), F.col("p_partkey").cast("double").alias("z"), F.col("p_size").cast("double").alias("radius"), (F.col("p_partkey") % 5 + 1).cast("int").alias("confidence"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """point_id, kind, x, y, z."""
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("point_id"), F.col("label").alias("kind"), *[e[i].cast("double").alias(c) for i, c in enumerate("xyz")])


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, ts, action."""
    return table(spark, sf_dir, "events").select("user_id", "ts", F.col("event_type").alias("action"))


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, annotation: the words of a part's name, its brand and its type."""
    part = table(spark, sf_dir, "part")
    words = F.array_union(F.array_distinct(F.split("p_name", " ")), F.array("p_brand", "p_type"))
    return part.select(F.col("p_partkey").alias("entity_id"), F.explode(words).alias("annotation"))


def _after(start: str, hours: str, minutes: str = "0"):
    """A time that many hours and minutes after ``start``."""
    return F.expr(f"timestamp_ntz'{start}' + make_dt_interval(0, CAST({hours} AS INT), CAST({minutes} AS INT), 0)")


def treenodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes with skeleton (the brand's number), creator, editor and times."""
    who = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("node_id"), F.substring("p_brand", 7, 9).cast("long").alias("skeleton_id"), (F.col("p_partkey") % 25).alias("creator_id"), (F.col("p_partkey") * 7 % 25).alias("editor_id"),
        _after("2020-01-01 00:00:00", "p_partkey").alias("created"), _after("2020-01-01 00:00:00", "p_partkey", "p_size - 20").alias("edited"),
    )
    return nodes(spark, sf_dir).join(who, "node_id")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node_id, reviewer_id, reviewed."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("node_id"), (F.col("l_suppkey") % 25).alias("reviewer_id"), F.col("l_shipdate").cast("timestamp_ntz").alias("reviewed")).distinct()


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """label_id, tag, node_id, kind: flags of line items on parts, states of orders on connectors, and a soma on the thick fifths."""
    line = table(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("tag"), F.col("l_partkey").alias("node_id"), F.lit("node").alias("kind"))
    order = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("tag"), F.col("o_orderkey").alias("node_id"), F.lit("connector").alias("kind"))
    soma = table(spark, sf_dir, "part").where("p_partkey % 5 = 0").select(F.lit("soma").alias("tag"), F.col("p_partkey").alias("node_id"), F.lit("node").alias("kind"))
    return line.unionByName(order).unionByName(soma).distinct().select((F.ascii("tag") * 1000 + F.length("tag")).cast("long").alias("label_id"), "tag", "node_id", "kind")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, login, full_name, first_name, last_name."""
    name = F.col("n_name")
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("user_id"), F.lower(name).alias("login"), F.when(F.col("n_nationkey") % 3 > 0, name).alias("full_name"), F.split(name, "_")[0].alias("first_name"), F.when(F.col("n_nationkey") % 2 == 0, F.split(name, "_")[1]).alias("last_name"))


def skeletons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """skeleton_id, neuron_id, name."""
    return table(spark, sf_dir, "part").select(F.substring("p_brand", 7, 9).cast("long").alias("skeleton_id"), F.col("p_brand").alias("name")).distinct().select("skeleton_id", F.floor(F.col("skeleton_id") / 2).alias("neuron_id"), "name")


def placed_connectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """connector_id, x, y, z, creator_id, created."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("connector_id"), F.col("o_totalprice").alias("x"), F.col("o_custkey").cast("double").alias("y"), (F.col("o_orderkey") % 1000).cast("double").alias("z"), (F.col("o_custkey") % 25).alias("creator_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("created"))


def node_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """connector_id, node_id, skeleton_id, relation, confidence, creator_id, created: customers before a connector, suppliers and their parts behind it."""
    order, line = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    pre = order.select(F.col("o_orderkey").alias("connector_id"), F.col("o_custkey").alias("node_id"), F.col("o_custkey").alias("skeleton_id"), F.lit("presynaptic_to").alias("relation"), F.lit(5).alias("confidence"), (F.col("o_custkey") % 25).alias("creator_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("created"))
    post = line.select(F.col("l_orderkey").alias("connector_id"), F.col("l_partkey").alias("node_id"), F.col("l_suppkey").alias("skeleton_id"), F.lit("postsynaptic_to").alias("relation"), ((F.col("l_linenumber") - 1) % 5 + 1).alias("confidence"), (F.col("l_suppkey") % 25).alias("creator_id"), F.col("l_shipdate").cast("timestamp_ntz").alias("created"))
    return pre.unionByName(post)


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """annotation_id, entity_id, user_id, marked: events mark users' neurons with kinds; two kinds of kinds mark the kinds."""
    e = table(spark, sf_dir, "events")
    kind = F.ascii("event_type").cast("long") * 100 + F.length("event_type")
    own = e.select(kind.alias("annotation_id"), (F.col("user_id") + 1_000_000).alias("entity_id"), (F.col("event_id") % 25).alias("user_id"), F.col("ts").cast("timestamp_ntz").alias("marked"))
    meta = e.groupBy(kind.alias("entity_id")).agg(F.min("ts").cast("timestamp_ntz").alias("marked")).select((F.col("entity_id") % 2 + 1).alias("annotation_id"), "entity_id", F.lit(0).cast("long").alias("user_id"), "marked")
    top = meta.select(F.lit(3).cast("long").alias("annotation_id"), F.col("annotation_id").alias("entity_id"), "user_id", "marked").groupBy("annotation_id", "entity_id", "user_id").agg(F.min("marked").alias("marked"))
    return own.unionByName(meta).unionByName(top)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, kind, name: neurons of users, and all annotations."""
    e = table(spark, sf_dir, "events")
    neuron = e.select((F.col("user_id") + 1_000_000).alias("entity_id"), F.lit("neuron").alias("kind"), F.concat(F.lit("neuron "), F.col("user_id") % 100).alias("name")).distinct()
    kinds = e.select((F.ascii("event_type").cast("long") * 100 + F.length("event_type")).alias("entity_id"), F.lit("annotation").alias("kind"), F.col("event_type").alias("name")).distinct()
    meta = spark.range(1, 4).select(F.col("id").alias("entity_id"), F.lit("annotation").alias("kind"), F.concat(F.lit("meta "), "id").alias("name"))
    return neuron.unionByName(kinds).unionByName(meta)
