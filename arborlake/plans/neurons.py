"""Queries about whole neurons over the star-schema views, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import neurons as n
from ..sources import lake


def _part_tags(spark, d):
    tag = F.when(F.col("p_partkey") % 3 == 0, "ends").when(F.col("p_partkey") % 5 == 0, "soma").otherwise("other")
    return lake.table(spark, d, "part").select(F.col("p_partkey").alias("node_id"), tag.alias("tag"))


def open_ends(spark, d):
    return n.open_ends(lake.nodes(spark, d), _part_tags(spark, d)).select("node_id")


def somas(spark, d):
    return n.somas(lake.nodes(spark, d), _part_tags(spark, d), 20.0).select("node_id")


def summary(spark, d):
    names = lake.table(spark, d, "part").select(F.col("p_partkey").alias("node_id"), F.col("p_brand").alias("neuron"))
    contacts = lake.table(spark, d, "lineitem").select(F.col("l_partkey").alias("node_id"))
    return n.summary(lake.nodes(spark, d).join(names, "node_id"), contacts, "neuron")


def duplicates(spark, d):
    return n.remove_duplicates(lake.table(spark, d, "part").select("p_partkey", "p_brand", "p_size"), ["p_brand", "p_size"], ["p_partkey"])


def connector_links(spark, d):
    ids = lake.table(spark, d, "supplier").where("s_nationkey = 3").select(F.col("s_suppkey").cast("long").alias("id"))
    return n.connector_links(lake.connectors(spark, d), lake.links(spark, d), ids)


def user_annotations(spark, d):
    return n.user_annotations(lake.actions(spark, d).select("user_id", F.col("action").alias("annotation")))


QUERIES = {"open_ends": open_ends, "somas": somas, "neuron_summary": summary, "remove_duplicates": duplicates, "connector_links": connector_links, "user_annotations": user_annotations}

_PARENT = "(SELECT p_partkey // 2 AS node_id, count(*) AS k FROM part WHERE p_partkey > 0 GROUP BY 1)"
SQL = {
    "open_ends": f"SELECT p_partkey AS node_id FROM part LEFT JOIN {_PARENT} ON node_id = p_partkey WHERE k IS NULL AND p_partkey > 0 AND p_partkey % 3 <> 0 AND p_partkey % 5 <> 0",
    "somas": "SELECT p_partkey AS node_id FROM part WHERE p_size * 20 >= 500 AND p_partkey % 3 <> 0 AND p_partkey % 5 = 0",
    "neuron_summary": f"SELECT p_brand AS neuron, count(*) AS n_nodes, CAST(coalesce(sum(c), 0) AS BIGINT) AS n_connectors, count(*) FILTER (k >= 2 AND p_partkey > 0) AS n_branches, count(*) FILTER (k IS NULL AND p_partkey > 0) AS n_leafs FROM part LEFT JOIN {_PARENT} ON node_id = p_partkey LEFT JOIN (SELECT l_partkey, count(*) AS c FROM lineitem GROUP BY 1) ON l_partkey = p_partkey GROUP BY 1",
    "remove_duplicates": "SELECT min(p_partkey) AS p_partkey, p_brand, p_size FROM part GROUP BY p_brand, p_size",
    "connector_links": "WITH s AS (SELECT s_suppkey AS id FROM supplier WHERE s_nationkey = 3) SELECT o_orderkey AS connector_id, CAST(o_custkey AS BIGINT) AS id, 'presynaptic_to' AS relation FROM orders WHERE o_custkey IN (SELECT id FROM s) UNION ALL SELECT l_orderkey, CAST(l_suppkey AS BIGINT), 'postsynaptic_to' FROM lineitem WHERE l_suppkey IN (SELECT id FROM s)",
    "user_annotations": "SELECT user_id, event_type AS annotation, count(*) AS times_used FROM events GROUP BY 1, 2",
}
