"""Queries of changes, names, landmarks of two projects and image stacks, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import mutate as m
from ..sources import lake


def _tags(s, d):
    return lake.tags(s, d).where("kind = 'node'").select("node_id", "tag")


def _parts(s, d, where="true"):
    return lake.table(s, d, "part").where(where)


def _nodes(s, d):
    return lake.treenodes(s, d).select("node_id", "parent_id", "skeleton_id", "x", "y", "z", "radius", "confidence")


def _skeletons(s, d, where):
    return lake.skeletons(s, d).where(where)


def add_tags(s, d):
    return m.add_tags(_tags(s, d), _parts(s, d, "p_size < 20").select(F.col("p_partkey").alias("node_id"), F.lit("new").alias("tag")), override=True)


def delete_tags(s, d):
    return m.delete_tags(_tags(s, d), _parts(s, d, "p_size < 20").select(F.col("p_partkey").alias("node_id")), ["soma", "AF"])


def add_annotations(s, d):
    return m.add_annotations(lake.annotations(s, d), _parts(s, d, "p_size < 10").select(F.col("p_partkey").alias("entity_id")), ["red", "checked"])


def remove_annotations(s, d):
    return m.remove_annotations(lake.annotations(s, d), ["red", "Brand#2"])


def add_meta(s, d):
    notes = lake.annotations(s, d).select(F.col("annotation").alias("entity_id")).distinct()
    return m.add_annotations(notes.where("entity_id LIKE 'Brand%'").select("entity_id", F.lit("brand").alias("annotation")), notes, ["any"])


def remove_meta(s, d):
    notes = lake.annotations(s, d).select(F.col("annotation").alias("entity_id")).distinct()
    return m.remove_annotations(notes.select("entity_id", F.lit("any").alias("annotation")), ["any"], notes.where("entity_id LIKE 'Brand%'"))


def rename(s, d):
    k = lake.skeletons(s, d)
    return m.rename(k, k.where("skeleton_id % 2 = 0").select("skeleton_id", F.concat(F.lit("new "), "name").alias("name")))


def confidence(s, d):
    n = _nodes(s, d).select("node_id", "confidence")
    return m.set_confidence(n, n.where("node_id % 4 = 1").select("node_id", F.lit(5).alias("confidence")))


def moved(s, d):
    n = _nodes(s, d).select("node_id", "x", "y", "z")
    return m.update(n, n.where("node_id % 4 = 1").select("node_id", (F.col("x") + 1).alias("x"), (-F.col("y")).alias("y"), "z"), "node_id")


def deleted(s, d):
    links = lake.node_links(s, d).where("node_id % 7 <> 3")
    n = _nodes(s, d)
    return m.delete_unlinked(n, n.where("node_id % 7 = 3"), links).select("node_id", "parent_id")


def deleted_neurons(s, d):
    return m.delete_neurons(_nodes(s, d), _skeletons(s, d, "neuron_id % 3 = 0")).select("node_id", "skeleton_id")


def reviewed(s, d):
    return m.set_reviewed(lake.reviews(s, d).select("node_id", F.col("reviewer_id").cast("string").alias("reviewer")).distinct(), _nodes(s, d).where("radius > 40"), "1")


def linked(s, d):
    k = lake.node_links(s, d).select("connector_id", "node_id", "skeleton_id", "relation")
    return m.link_connector(k, _nodes(s, d).where("radius = 7").select(F.lit(-1).cast("long").alias("connector_id"), "node_id", "skeleton_id", F.lit("abutting").alias("relation"))).groupBy("relation").agg(F.count("*").alias("n"), F.sum("node_id").alias("nodes"))


def connectors_added(s, d):
    c = lake.placed_connectors(s, d).select(F.col("connector_id").alias("point_id"), F.floor("x").alias("x"), "y", "z")
    new = c.where("point_id % 5 = 0").select((F.col("point_id") + 10_000_000).alias("point_id"), (F.col("x") + F.when(F.col("point_id") % 2 == 0, 0.5).otherwise(2_000_000)).alias("x"), "y", "z")
    return m.add_connectors(c.withColumn("x", F.col("x").cast("double")), new).where("point_id >= 10000000").select("point_id")


def nodes_added(s, d):
    n = _nodes(s, d)
    new = n.where("node_id < 50").select((F.col("node_id") * 1000).alias("node_id"), F.col("node_id").alias("parent_id"), "skeleton_id", "x", "y", "z", F.lit(None).cast("double").alias("radius"), F.lit(None).cast("int").alias("confidence"))
    return m.add_nodes(n, new).where("node_id % 1000 = 0 OR node_id < 10").select("node_id", "parent_id", "radius", "confidence")


def diff_applied(s, d):
    n = _nodes(s, d)
    new = n.where("node_id % 10 <> 3").withColumn("x", F.when(F.col("node_id") % 10 == 4, F.col("x") - 1).otherwise(F.col("x"))).withColumn("confidence", F.lit(1)).unionByName(n.where("node_id < 5").withColumn("node_id", F.col("node_id") + 10_000_000))
    return m.apply_diff(n, new).select("node_id", "x", "confidence")


def imported(s, d):
    n = _nodes(s, d)
    swc = n.where("node_id < 31").select(F.col("node_id").cast("int").alias("node"), F.coalesce("parent_id", F.lit(-1)).cast("int").alias("parent"), "x", "y", "z", "radius")
    return m.import_skeleton(n.where("node_id % 100 = 0"), swc, 999, 5_000_000).select("node_id", "parent_id", "skeleton_id", "confidence")


def transferred(s, d):
    n = _nodes(s, d)
    return m.transfer(n, n.where("skeleton_id < 5"), _skeletons(s, d, "skeleton_id IN (7, 9)"), 1_000_000).select("node_id", "parent_id", "skeleton_id")


def replaced(s, d):
    n = _nodes(s, d)
    new = n.where("skeleton_id = 4").select((F.col("node_id") + 1_000_000).alias("node_id"), F.lit(None).cast("long").alias("parent_id"), "skeleton_id", (F.col("x") + 0.25).alias("x"), "y", "z", "radius", "confidence").where("node_id % 3 > 0")
    return m.replace_skeleton(n, new, lake.node_links(s, d).where("relation = 'postsynaptic_to'"), 4, 0.5)[1].groupBy((F.col("node_id") >= 1_000_000).alias("moved")).agg(F.count("*").alias("n"), F.sum("node_id").alias("nodes"))


def joined(s, d):
    n = _nodes(s, d).where("node_id > 0").withColumn("parent_id", F.when(~F.col("node_id").isin(1, 2, 3), F.col("parent_id"))).withColumn("skeleton_id", F.expr("CASE WHEN node_id = 1 THEN 1 ELSE 2 + (node_id div shiftleft(1, CAST(floor(log2(node_id)) AS INT) - 1)) % 2 END").cast("long"))
    return m.join_nodes(n, 2, 6).select("node_id", "parent_id", "skeleton_id")


def volumes(s, d):
    v = lake.points(s, d).where("point_id < 30").select(F.lit("old").alias("name"), F.floor(F.col("point_id") / 3).alias("face"), (F.col("point_id") % 3).alias("corner"), "x", "y", "z")
    both = m.add_volume(v, "new", v.where("face < 4"))
    return m.delete_volume(both, "old").select("name", "face", "corner", F.round("x", 6).alias("x"))


def parsed(s, d):
    name = F.concat_ws(" ", "p_type", "p_partkey", "p_name", F.lit("JJ"), F.lit("PS"))
    return _parts(s, d).select("p_partkey", text.parse_name(name).alias("n")).select("p_partkey", "n.*")


def shortened(s, d):
    """Names of two words, a number and initials: what goes first is the number, then the initials from the right."""
    name = F.concat_ws(" ", "p_type", F.lit("1234567890"), F.lit("JJ"), F.lit("PSX"))
    return _parts(s, d).select("p_partkey", text.shorten_name(name, 16).alias("name"))


def point_columns(s, d):
    n = lake.nodes(s, d).select(*[F.col(c).alias(f"at_{c}_nm") for c in "xyz"])
    return text.point_columns(n, "at_{}_nm")


def _project(s, d, k):
    p = lake.table(s, d, "supplier").select(F.concat(F.lit("g"), F.col("s_nationkey") % 3).alias("grp"), F.concat(F.lit("l"), F.floor(F.col("s_suppkey") / 2) % k).alias("landmark"), F.col("s_acctbal").alias("x"), F.col("s_suppkey").cast("double").alias("y"), F.lit(float(k)).alias("z"))
    return p.select("grp", "landmark"), p


def matched_all(s, d):
    return text.match_by_name(_project(s, d, 1000), _project(s, d, 1001))


def matched_groups(s, d):
    return text.match_by_name(_project(s, d, 1000), _project(s, d, 1001), ("g0", "g1"))


def group_members(s, d):
    out = text.group_members(*_project(s, d, 10))
    return out.withColumn("landmarks", F.array_join("landmarks", ","))


def control_points(s, d):
    return text.control_points(matched_all(s, d)).select(F.expr("points1[1]").alias("y1"), F.expr("points2[1]").alias("y2"), F.size("points1").cast("long").alias("n"))


def _stacks(s, d):
    mirror = F.struct(F.col("n_regionkey").alias("id"), F.concat(F.lit("mirror "), "n_regionkey").alias("title"), F.concat(F.lit("https://example.org/"), "n_nationkey").alias("base"))
    other = F.struct((F.col("n_regionkey") + 10).alias("id"), F.lit("copy").alias("title"), F.lit("https://example.net").alias("base"))
    return lake.table(s, d, "nation").select(F.col("n_nationkey").alias("stack_id"), F.col("n_name").alias("title"), F.array(mirror, other).alias("mirrors"), (F.col("n_nationkey") % 4).alias("orientation"))


def stacks(s, d):
    return _stacks(s, d).select("stack_id", "title", F.size("mirrors").cast("long").alias("n_mirrors"), text.axis_order(F.col("orientation")).alias("axes"), text.axis_order(F.col("orientation"), True).alias("reversed"), text.orientation_of(F.substring(text.axis_order(F.col("orientation")), 1, 2)).alias("orientation"))


def mirror(s, d):
    return text.mirrors(_stacks(s, d), "NATION_7", "copy").unionByName(text.mirrors(_stacks(s, d), "8", "3"))


def scales(s, d):
    level = F.col("n_nationkey") % 6
    axis = text.axis_coordinates(F.col("n_nationkey") + 1, F.lit(4.0), text.downsample(level, True), F.lit(100.0))
    return lake.table(s, d, "nation").select("n_nationkey", text.downsample(level, True).alias("plane"), text.downsample(level, False).alias("depth"), F.array_join(F.transform(axis, lambda v: v.cast("long").cast("string")), ",").alias("axis"))


def whole_slices(s, d):
    broken = lake.table(s, d, "supplier").select(F.col("s_suppkey").alias("slice"), (F.col("s_nationkey") % 3 - 1).alias("step")).where("slice % 4 > 1 AND step <> 0")
    broken = broken.where("NOT (slice % 4 = 2 AND step = 1)")
    return text.whole_slices(broken)


def tile_memory(s, d):
    from ..operators import spatial

    n = lake.nodes(s, d)
    boxes = n.select(F.col("node_id").alias("box_id"), F.col("y").alias("x1"), (F.col("y") + 500).alias("x2"), (F.col("x") * 100).alias("y1"), (F.col("x") * 100 + 300).alias("y2"), F.col("z").alias("z1"), (F.col("z") + 40).alias("z2"))
    return text.tile_memory(spatial.tiles(boxes, 64, 64, (4, 4, 40)), 64)


def boxes_around(s, d):
    return text.boxes_around(lake.nodes(s, d).select("node_id", "x", "y", "z"), (100.0, 50.0)).select("node_id", "x1", "x2", "y1", "y2", "z1")


QUERIES = {
    "add_tags": add_tags, "delete_tags": delete_tags, "add_annotations": add_annotations, "remove_annotations": remove_annotations, "add_meta_annotations": add_meta, "remove_meta_annotations": remove_meta, "rename_neurons": rename, "update_node_confidence": confidence,
    "move_nodes": moved, "delete_nodes": deleted, "delete_neuron": deleted_neurons, "set_nodes_reviewed": reviewed, "link_connector": linked, "add_connector": connectors_added, "add_node": nodes_added, "differential_upload": diff_applied, "upload_neuron": imported,
    "transfer_neuron": transferred, "replace_skeleton": replaced, "join_nodes": joined, "upload_volume": volumes, "parse_neuronname": parsed, "shorten_name": shortened, "clean_points": point_columns, "match_all_landmarks": matched_all, "match_landmark_groups": matched_groups,
    "get_landmark_groups": group_members, "to_control_points": control_points, "get_stacks": stacks, "get_mirror_info": mirror, "get_scale": scales, "resolve_broken_slices": whole_slices, "estimate_memory": tile_memory, "bbox_helper": boxes_around,
}

_NODES = "n AS (SELECT p_partkey AS node_id, CASE WHEN p_partkey > 0 THEN p_partkey // 2 END AS parent_id, CAST(substr(p_brand, 7) AS BIGINT) AS skeleton_id, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, CAST(p_partkey AS DOUBLE) AS z, CAST(p_size AS DOUBLE) AS radius, CAST(p_partkey % 5 + 1 AS INT) AS confidence FROM part)"
_TAGS = "t AS (SELECT l_partkey AS node_id, l_returnflag || l_linestatus AS tag FROM lineitem UNION SELECT p_partkey, 'soma' FROM part WHERE p_partkey % 5 = 0)"
_ANN = "ann AS (SELECT DISTINCT p_partkey AS entity_id, unnest(list_concat(string_split(p_name, ' '), [p_brand, p_type])) AS annotation FROM part)"
_LAND = "u1 AS (SELECT 'g' || CAST(s_nationkey % 3 AS VARCHAR) AS grp, 'l' || CAST(s_suppkey // 2 % 1000 AS VARCHAR) AS landmark, any_value(s_acctbal) AS x1, CAST(any_value(s_suppkey) AS DOUBLE) AS y1, 1000.0::DOUBLE AS z1 FROM supplier GROUP BY 1, 2 HAVING count(*) = 1), u2 AS (SELECT 'g' || CAST(s_nationkey % 3 AS VARCHAR) AS grp, 'l' || CAST(s_suppkey // 2 % 1001 AS VARCHAR) AS landmark, any_value(s_acctbal) AS x2, CAST(any_value(s_suppkey) AS DOUBLE) AS y2, 1001.0::DOUBLE AS z2 FROM supplier GROUP BY 1, 2 HAVING count(*) = 1)"
_STACK = "CASE n_nationkey % 4 WHEN 0 THEN 'xyz' WHEN 1 THEN 'xzy' WHEN 2 THEN 'zyx' END"

SQL = {
    "add_tags": f"WITH {_TAGS} SELECT node_id, tag FROM t JOIN part ON p_partkey = node_id WHERE p_size >= 20 UNION ALL SELECT p_partkey, 'new' FROM part WHERE p_size < 20",
    "delete_tags": f"WITH {_TAGS} SELECT node_id, tag FROM t JOIN part ON p_partkey = node_id WHERE NOT (p_size < 20 AND tag IN ('soma', 'AF'))",
    "add_annotations": f"WITH {_ANN} SELECT entity_id, annotation FROM ann UNION SELECT p_partkey, unnest(['red', 'checked']) FROM part WHERE p_size < 10",
    "remove_annotations": f"WITH {_ANN} SELECT entity_id, annotation FROM ann WHERE annotation NOT IN ('red', 'Brand#2')",
    "add_meta_annotations": f"WITH {_ANN}, a AS (SELECT DISTINCT annotation AS entity_id FROM ann) SELECT entity_id, 'brand' AS annotation FROM a WHERE entity_id LIKE 'Brand%' UNION ALL SELECT entity_id, 'any' FROM a",
    "remove_meta_annotations": f"WITH {_ANN} SELECT DISTINCT annotation AS entity_id, 'any' AS annotation FROM ann WHERE annotation NOT LIKE 'Brand%'",
    "rename_neurons": "SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS skeleton_id, CAST(substr(p_brand, 7) AS BIGINT) // 2 AS neuron_id, CASE WHEN CAST(substr(p_brand, 7) AS BIGINT) % 2 = 0 THEN 'new ' || p_brand ELSE p_brand END AS name FROM part",
    "update_node_confidence": "SELECT p_partkey AS node_id, CAST(CASE WHEN p_partkey % 4 = 1 THEN 5 ELSE p_partkey % 5 + 1 END AS INT) AS confidence FROM part",
    "move_nodes": f"WITH {_NODES} SELECT node_id, CASE WHEN node_id % 4 = 1 THEN x + 1 ELSE x END AS x, CASE WHEN node_id % 4 = 1 THEN -y ELSE y END AS y, z FROM n",
    "delete_nodes": f"WITH {_NODES} SELECT node_id, CASE WHEN parent_id % 7 <> 3 THEN parent_id END AS parent_id FROM n WHERE node_id % 7 <> 3",
    "delete_neuron": f"WITH {_NODES} SELECT node_id, skeleton_id FROM n WHERE skeleton_id // 2 % 3 <> 0",
    "set_nodes_reviewed": "SELECT DISTINCT l_partkey AS node_id, CAST(l_suppkey % 25 AS VARCHAR) AS reviewer FROM lineitem UNION SELECT p_partkey, '1' FROM part WHERE p_size > 40",
    "link_connector": "SELECT relation, count(*) AS n, CAST(sum(x) AS BIGINT) AS nodes FROM (SELECT 'presynaptic_to' AS relation, o_custkey AS x FROM orders UNION ALL SELECT 'postsynaptic_to', l_partkey FROM lineitem UNION ALL SELECT 'abutting', p_partkey FROM part WHERE p_size = 7) GROUP BY 1",
    "add_connector": "SELECT o_orderkey + 10000000 AS point_id FROM orders WHERE o_orderkey % 10 = 5",
    "add_node": f"WITH {_NODES} SELECT node_id, parent_id, radius, confidence FROM n WHERE node_id % 1000 = 0 OR node_id < 10 UNION ALL SELECT node_id * 1000, node_id, -1.0, 5 FROM n WHERE node_id < 50 AND node_id * 1000 NOT IN (SELECT node_id FROM n)",
    "differential_upload": f"WITH {_NODES} SELECT node_id, CASE WHEN node_id % 10 = 4 THEN x - 1 ELSE x END AS x, confidence FROM n WHERE node_id % 10 <> 3 UNION ALL SELECT node_id + 10000000, x, confidence FROM n WHERE node_id < 5",
    "upload_neuron": f"WITH {_NODES} SELECT node_id, parent_id, skeleton_id, confidence FROM n WHERE node_id % 100 = 0 UNION ALL SELECT node_id + 5000000, parent_id + 5000000, 999, 5 FROM n WHERE node_id < 31",
    "transfer_neuron": f"WITH {_NODES} SELECT node_id, parent_id, skeleton_id FROM n WHERE skeleton_id < 5 UNION ALL SELECT node_id + 1000000, parent_id + 1000000, skeleton_id + 1000000 FROM n WHERE skeleton_id IN (7, 9)",
    "replace_skeleton": f"WITH {_NODES}, k AS (SELECT CASE WHEN substr(p_brand, 7) <> '4' THEN l_partkey WHEN (l_partkey + 1000000) % 3 > 0 THEN l_partkey + 1000000 END AS id FROM lineitem JOIN part ON p_partkey = l_partkey) SELECT id >= 1000000 AS moved, count(*) AS n, CAST(sum(id) AS BIGINT) AS nodes FROM k GROUP BY 1",
    "join_nodes": "SELECT p_partkey AS node_id, CAST(CASE WHEN p_partkey IN (1, 2) THEN NULL WHEN p_partkey = 6 THEN 2 WHEN p_partkey = 3 THEN 6 ELSE p_partkey // 2 END AS BIGINT) AS parent_id, CAST(CASE WHEN p_partkey = 1 THEN 1 ELSE 2 END AS BIGINT) AS skeleton_id FROM part WHERE p_partkey > 0",
    "upload_volume": "SELECT 'new' AS name, vec_id // 3 AS face, vec_id % 3 AS corner, round(CAST(embedding[1] AS DOUBLE), 6) AS x FROM embeddings WHERE vec_id < 12",
    "parse_neuronname": "SELECT p_partkey, p_type AS type, p_name AS nickname, 'JJ PS' AS tracer, CAST(p_partkey AS VARCHAR) AS generic FROM part",
    "shorten_name": "SELECT p_partkey, CASE WHEN length(p_type) + 12 <= 16 THEN p_type || ' [..] JJ PSX' WHEN length(p_type) + 13 <= 16 THEN p_type || ' [..] JJ [..]' ELSE p_type || ' [..]' END AS name FROM part",
    "clean_points": f"WITH {_NODES} SELECT x, y, z FROM n",
    "match_all_landmarks": f"WITH {_LAND} SELECT u1.grp, u1.landmark, x1, y1, z1, x2, y2, z2 FROM u1 JOIN u2 USING (grp, landmark)",
    "match_landmark_groups": f"WITH {_LAND} SELECT u1.grp, u1.landmark, x1, y1, z1, x2, y2, z2 FROM u1 JOIN u2 USING (landmark) WHERE u1.grp = 'g0' AND u2.grp = 'g1'",
    "get_landmark_groups": "SELECT 'g' || CAST(s_nationkey % 3 AS VARCHAR) AS grp, array_to_string(list_sort(list_distinct(list('l' || CAST(s_suppkey // 2 % 10 AS VARCHAR)))), ',') AS landmarks, count(*) AS n_locations FROM supplier GROUP BY 1",
    "to_control_points": f"WITH {_LAND} SELECT y1, y2, CAST(3 AS BIGINT) AS n FROM u1 JOIN u2 USING (grp, landmark)",
    "get_stacks": f"SELECT n_nationkey AS stack_id, n_name AS title, CAST(2 AS BIGINT) AS n_mirrors, {_STACK} AS axes, reverse({_STACK}) AS reversed, CASE WHEN n_nationkey % 4 < 3 THEN n_nationkey % 4 END AS orientation FROM nation",
    "get_mirror_info": "SELECT n_nationkey AS stack_id, n_regionkey + 10 AS id, 'copy' AS title, 'https://example.net' AS base FROM nation WHERE n_name = 'NATION_7' UNION ALL SELECT n_nationkey, n_regionkey, 'mirror ' || CAST(n_regionkey AS VARCHAR), 'https://example.org/8' FROM nation WHERE n_nationkey = 8 AND n_regionkey = 3",
    "get_scale": "SELECT n_nationkey, CAST(2 ** (n_nationkey % 6) AS BIGINT) AS plane, CAST(1 AS BIGINT) AS depth, array_to_string(list_transform(range(0, n_nationkey + 1), lambda i: CAST(i * 4 * 2 ** (n_nationkey % 6) + 100 AS BIGINT)), ',') AS axis FROM nation",
    "resolve_broken_slices": "WITH RECURSIVE b AS (SELECT s_suppkey AS slice, s_nationkey % 3 - 1 AS step FROM supplier WHERE s_suppkey % 4 > 1 AND s_nationkey % 3 <> 1 AND NOT (s_suppkey % 4 = 2 AND s_nationkey % 3 = 2)), w AS (SELECT slice, slice + step AS use FROM b UNION ALL SELECT w.slice, w.use + b.step FROM w JOIN b ON b.slice = w.use) SELECT slice, CAST(use AS BIGINT) AS use FROM w WHERE use NOT IN (SELECT slice FROM b)",
    "estimate_memory": "WITH b AS (SELECT CAST(floor(p_retailprice / 4 + 0.5) AS BIGINT) AS x1, CAST(floor((p_retailprice + 500) / 4 + 0.5) AS BIGINT) AS x2, CAST(floor(p_size * 100 / 4 + 0.5) AS BIGINT) AS y1, CAST(floor((p_size * 100 + 300) / 4 + 0.5) AS BIGINT) AS y2, CAST(floor(p_partkey / 40 + 0.5) AS BIGINT) AS z1, CAST(floor((p_partkey + 40) / 40 + 0.5) AS BIGINT) AS z2 FROM part), z AS (SELECT *, unnest(range(z1, z2 + 1)) AS z FROM b), c AS (SELECT *, unnest(range(x1 // 64, x2 // 64 + 1)) AS col FROM z), t AS (SELECT DISTINCT z, col, unnest(range(y1 // 64, y2 // 64 + 1)) AS row FROM c) SELECT count(*) * 64 * 64 * 8 AS bytes FROM t",
    "bbox_helper": f"WITH {_NODES} SELECT node_id, x - 50 AS x1, x + 50 AS x2, y - 25 AS y1, y + 25 AS y2, z AS z1 FROM n",
}
