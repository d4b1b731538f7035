"""Queries of viewer addresses, volumes, versions, unions, selections and time by neuron, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text
from ..operators import activity, neurons, search, spatial, trees
from ..sources import lake, selection
from .shapes import NODES


def viewer(s, d):
    n = lake.nodes(s, d)
    return n.select("node_id", text.viewer_url("https://example.org/v", F.col("x"), F.col("y"), F.col("z"), 5, 2).alias("url"))


def tile_addresses(s, d):
    n = lake.nodes(s, d)
    col = lambda k: F.floor(F.col(k) / 64)
    return n.select("node_id", *[text.tile_url(k, "https://example.org/t/", F.col("node_id") % 3, col("y"), col("x"), F.col("node_id"), 64, 64).alias(f"layout{k}") for k in (1, 4, 5)])


def volumes(s, d):
    one = lambda k: F.concat_ws(" ", (F.col("s_suppkey") + k).cast("string"), F.lit(str(k)), F.lit("0.5"))
    xml = F.concat(F.lit("<Shape><IndexedTriangleSet index='0 1 2 0 2 3'><Coordinate point='"), F.concat_ws(" ", *[one(k) for k in range(4)]), F.lit("'/></IndexedTriangleSet></Shape>"))
    other = F.concat(F.lit("<Shape><IndexedFaceSet coordIndex='0 1 2 -1'><Coordinate point='"), F.concat_ws(", ", *[one(k) for k in range(3)]), F.lit("'/></IndexedFaceSet></Shape>"))
    t = lake.table(s, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, xml).otherwise(other).alias("mesh"))
    v = t.select("s_suppkey", text.mesh_points(F.col("mesh")).alias("v"), text.mesh_faces(F.col("mesh")).alias("f"))
    return v.select("s_suppkey", F.size("v").cast("long").alias("n_vertices"), F.size("f").cast("long").alias("n_faces"), F.expr("aggregate(v, 0D, (s, p) -> s + p[0])").alias("x"), F.expr("aggregate(flatten(f), 0L, (s, i) -> s + i)").alias("corners"))


def landmarks(s, d):
    t = lake.table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("landmark_id")).agg(F.collect_list(F.struct(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("x"), F.lit(1.0).alias("y"), F.lit(2.0).alias("z"))).alias("locations"))
    return text.landmark_locations(t.withColumn("name", F.concat(F.lit("landmark "), "landmark_id")))


def node_ids(s, d):
    terms = lake.table(s, d, "part").select(F.when(F.col("p_partkey") % 2 == 0, F.col("p_partkey").cast("string")).otherwise(F.col("p_name")).alias("term"))
    return text.resolve_nodes(terms, lake.nodes(s, d).where("node_id % 5 = 1"), lake.connectors(s, d).where("connector_id % 7 = 3"))


def floats(s, d):
    return lake.table(s, d, "part").select("p_partkey", text.to_float(F.when(F.col("p_partkey") % 2 == 0, F.col("p_retailprice").cast("string")).otherwise(F.col("p_name"))).alias("value"))


def user_ids(s, d):
    users = lake.users(s, d)
    return search.resolve_users(["nation_3", "NATION", "7", "8", "NATION_11", "nobody"], users)


def by_neuron(s, d):
    acts = lake.table(s, d, "events").select((F.col("event_id") % 40).alias("neuron"), "ts", F.col("event_type").alias("action"))
    return activity.time_invested(acts, 420, 1 / 140, by="neuron")


def versions(s, d):
    p = lake.table(s, d, "part")
    own = p.select(F.col("p_partkey").alias("node_id"), F.when(F.col("p_partkey") > 0, F.expr("p_partkey div 2")).alias("parent_id"), F.col("p_size").alias("created"), (F.col("p_size") + F.col("p_partkey") % 40 - 5).alias("modified"))
    return trees.time_machine(own, F.lit(25)).select("node_id", "parent_id")


def united(s, d):
    n = lake.nodes(s, d).select("node_id", "parent_id", "x", "y", "z")
    base = n.where("node_id < 100").withColumn("z", F.lit(0.0))
    other = n.where("node_id < 150").select((F.col("node_id") + 1_000_000).alias("node_id"), (F.col("parent_id") + 1_000_000).alias("parent_id"), "x", F.col("y") + 0.04, F.lit(0.0).alias("z")).toDF("node_id", "parent_id", "x", "y", "z")
    return spatial.union_neurons(base, other, 0.05).select("node_id", "parent_id")


def without_tagged(s, d):
    tags = lake.tags(s, d).where("kind = 'node'").select("node_id", "tag").unionByName(s.range(40, 42).select(F.col("id").alias("node_id"), F.lit("cut here").alias("tag")))
    return trees.remove_tagged(lake.nodes(s, d), tags, "cut here", "distal").select("node_id", "parent_id")


def gaps(s, d):
    links = lake.node_links(s, d).withColumn("relation", F.when(F.col("node_id") % 9 == 1, "gapjunction_with").when(F.col("node_id") % 9 == 2, "2").otherwise(F.col("relation")))
    return neurons.gap_junctions(links).groupBy("relation").agg(F.count("*").alias("n"))


def selected(s, d):
    folder = f"{trees.shared_dir(s)}/selection-{uuid.uuid4().hex}"
    selection.to_selection(lake.skeletons(s, d).where("skeleton_id > 3"), folder, "#00ff00")
    return selection.from_selection(s, folder)


QUERIES = {
    "url_to_coordinates": viewer, "tile_urls": tile_addresses, "get_volume": volumes, "get_landmarks": landmarks, "eval_node_ids": node_ids, "to_float": floats, "eval_user_ids": user_ids, "time_invested_by_neuron": by_neuron,
    "time_machine": versions, "union_neurons": united, "remove_tagged_branches": without_tagged, "gap_junctions": gaps, "selection_files": selected,
}

SQL = {
    "url_to_coordinates": f"WITH {NODES} SELECT node_id, 'https://example.org/v/?zp=' || CAST(CAST(round(z) AS BIGINT) AS VARCHAR) || '&yp=' || CAST(CAST(floor(y + 0.5) AS BIGINT) AS VARCHAR) || '&xp=' || CAST(CAST(round(x) AS BIGINT) AS VARCHAR) || '&tool=tracingtool&sid0=5&s0=2' AS url FROM n",
    "tile_urls": f"WITH {NODES}, t AS (SELECT node_id, CAST(node_id % 3 AS VARCHAR) AS m, CAST(CAST(floor(y / 64) AS BIGINT) AS VARCHAR) AS r, CAST(CAST(floor(x / 64) AS BIGINT) AS VARCHAR) AS c, CAST(node_id AS VARCHAR) AS z, 'https://example.org/t/' AS b FROM n) SELECT node_id, b || z || '/' || r || '_' || c || '_' || m || '.jpg' AS layout1, b || z || '/' || m || '/' || r || '_' || c || '.jpg' AS layout4, b || m || '/' || z || '/' || r || '/' || c || '.jpg' AS layout5 FROM t",
    "get_volume": "SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 2 = 0 THEN 4 ELSE 3 END AS BIGINT) AS n_vertices, CAST(CASE WHEN s_suppkey % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_faces, CAST(CASE WHEN s_suppkey % 2 = 0 THEN 4 * s_suppkey + 6 ELSE 3 * s_suppkey + 3 END AS DOUBLE) AS x, CAST(CASE WHEN s_suppkey % 2 = 0 THEN 8 ELSE 3 END AS BIGINT) AS corners FROM supplier",
    "get_landmarks": "SELECT s_nationkey AS landmark_id, 'landmark ' || CAST(s_nationkey AS VARCHAR) AS name, s_suppkey AS location_id, s_acctbal AS x, 1.0::DOUBLE AS y, 2.0::DOUBLE AS z FROM supplier",
    "eval_node_ids": "SELECT p_partkey AS node_id FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 5 = 1 UNION SELECT o_orderkey FROM orders WHERE o_orderkey % 7 = 3",
    "to_float": "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_retailprice END AS value FROM part",
    "eval_user_ids": "SELECT * FROM (VALUES ('nation_3', 3::BIGINT), ('8', 8), ('NATION_11', 11)) t(term, user_id)",
    "time_invested_by_neuron": "WITH e AS (SELECT event_id % 40 AS neuron, floor(epoch(ts - (SELECT date_trunc('day', min(ts)) FROM events)) / 25200) AS bin FROM events), b AS (SELECT neuron, bin, count(*) AS n FROM e GROUP BY 1, 2) SELECT neuron, CAST(sum(CASE WHEN n >= 3 THEN 420 ELSE 0 END) AS BIGINT) AS minutes FROM b GROUP BY 1 HAVING sum(n) >= 3",
    "time_machine": "WITH v AS (SELECT p_partkey AS node_id, CASE WHEN p_partkey > 0 THEN p_partkey // 2 END AS parent_id, p_size AS c, p_size + p_partkey % 40 - 5 AS m FROM part), k AS (SELECT node_id, parent_id FROM v WHERE c <= 25 AND (m >= 25 OR c > m) AND c <> m) SELECT node_id, CASE WHEN parent_id IN (SELECT node_id FROM k) THEN parent_id END AS parent_id FROM k",
    "union_neurons": f"WITH {NODES}, b AS (SELECT node_id, parent_id, x, y FROM n WHERE node_id < 100), o AS (SELECT node_id + 1000000 AS node_id, parent_id + 1000000 AS parent_id, x, y + 0.04 AS y FROM n WHERE node_id < 150), c AS (SELECT o.node_id AS old, arg_min(b.node_id, (sqrt((o.x - b.x) ** 2 + (o.y - b.y) ** 2), b.node_id)) AS new FROM o JOIN b ON sqrt((o.x - b.x) ** 2 + (o.y - b.y) ** 2) <= 0.05 GROUP BY 1) SELECT node_id, parent_id FROM b UNION ALL SELECT node_id, coalesce(c.new, parent_id) FROM o LEFT JOIN c ON old = parent_id WHERE node_id NOT IN (SELECT old FROM c)",
    "remove_tagged_branches": f"WITH RECURSIVE {NODES}, r AS (SELECT node_id FROM n WHERE parent_id IN (40, 41) UNION ALL SELECT n.node_id FROM n JOIN r ON n.parent_id = r.node_id) SELECT node_id, parent_id FROM n WHERE node_id NOT IN (SELECT node_id FROM r)",
    "gap_junctions": "WITH l AS (SELECT o_custkey AS node_id FROM orders UNION ALL SELECT l_partkey FROM lineitem) SELECT CASE node_id % 9 WHEN 1 THEN 'gapjunction_with' ELSE '2' END AS relation, count(*) AS n FROM l WHERE node_id % 9 IN (1, 2) GROUP BY 1",
    "selection_files": "SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS skeleton_id, '#00ff00' AS color, 1.0::DOUBLE AS opacity FROM part WHERE CAST(substr(p_brand, 7) AS BIGINT) > 3",
}
