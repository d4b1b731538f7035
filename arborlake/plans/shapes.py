"""Queries on trees, space, clusters, labels, tiles and changes, with their SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import text
from ..operators import clustering, mutate, spatial, trees
from ..sources import lake
from ..streaming import live
from . import network

NODES = "n AS (SELECT p_partkey AS node_id, CASE WHEN p_partkey > 0 THEN p_partkey // 2 END AS parent_id, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, CAST(p_partkey AS DOUBLE) AS z, p_partkey % 5 + 1 AS confidence FROM part), e AS (SELECT a.*, coalesce(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2), 0) AS length FROM n a LEFT JOIN n b ON a.parent_id = b.node_id)"
UP = NODES + ", r AS (SELECT node_id, parent_id, length AS distance, 0 AS hops FROM e WHERE parent_id IS NULL UNION ALL SELECT e.node_id, e.parent_id, r.distance + e.length, r.hops + 1 FROM e JOIN r ON e.parent_id = r.node_id)"


def _round(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _chains(spark, d):
    """Conversations as chains of nodes."""
    key = F.col("conv_id") * 100_000 + F.col("turn")
    c = lake.table(spark, d, "conversations").select("conv_id", key.alias("node_id"), "turn").distinct()
    known = c.select(F.col("node_id").alias("parent_id"), F.lit(True).alias("known"))
    return c.withColumn("parent_id", F.col("node_id") - 1).join(known, "parent_id", "left").select("conv_id", "node_id", F.when(F.col("known"), F.col("parent_id")).alias("parent_id"), F.lit(0.0).alias("x"), F.col("turn").cast("double").alias("y"), F.lit(0.0).alias("z"))


def _top(spark, i):
    return spark.range(1).select(F.lit(i).cast("long").alias("node_id"))


def _pairs(spark, d):
    n = lake.nodes(spark, d).where("node_id < 60").select("node_id")
    return n.alias("p").join(n.alias("q"), F.col("p.node_id") < F.col("q.node_id")).select(F.col("p.node_id").alias("a"), F.col("q.node_id").alias("b"))


def geodesic_segments(spark, d):
    """Every node below the root with the lower end of its unbranched stretch: pairs linear in the nodes."""
    n = lake.nodes(spark, d)
    pairs = trees.small_segments(n).select(F.col("node_id").alias("a"), F.col("segment").alias("b"))
    return _round(trees.geodesic(n, pairs), "distance")


def strahler(spark, d):
    return trees.strahler(lake.nodes(spark, d))


def density(spark, d):
    contacts = lake.table(spark, d, "part").select((F.col("p_partkey") % 7).alias("grp"), F.col("p_partkey").alias("node_id"))
    return _round(trees.connection_density(lake.nodes(spark, d), contacts, "MEDIAN", 1000.0), "density")


def nearest(spark, d):
    p = lake.points(spark, d).select("point_id", "kind", "x", "y", "z")
    return _round(spatial.nearest(p.where("kind = 0"), p.where("kind = 1"), 0.15), "distance", digits=9)


def within(spark, d):
    p = lake.points(spark, d).select("point_id", "kind", "x", "y", "z")
    return spatial.within(p.where("kind = 2"), p.where("kind = 3"), 0.1).select("a", "b")


def predicted(spark, d):
    p = lake.points(spark, d)
    pre = p.where("kind < 5").select("point_id", F.col("kind").alias("source"), "x", "y", "z")
    return spatial.predict_connectivity(pre, p.where("kind >= 5").select("point_id", F.col("kind").alias("target"), "x", "y", "z"), 0.08)


def _neurons(spark, d):
    p = lake.points(spark, d)
    return p.select("point_id", (F.col("point_id") % 6).alias("neuron"), "kind", "x", "y", "z")


def placement(spark, d):
    return _round(spatial.synapse_similarity(_neurons(spark, d), 0.1, 0.2), "similarity")


def radius(spark, d):
    n = trees.cut(trees.with_length(lake.nodes(spark, d)).where("length > 0").select("length"))  # for each pass of the quartiles
    return _round(spatial.contact_radius(n, "length"), "radius", digits=4)


def mesh(spark, d):
    v = np.array([[a, b, c] for a in (-0.1, 0.1) for b in (-0.1, 0.1) for c in (-0.1, 0.1)])
    f = np.array([[0, 1, 3], [0, 3, 2], [4, 6, 7], [4, 7, 5], [0, 4, 5], [0, 5, 1], [2, 3, 7], [2, 7, 6], [0, 2, 6], [0, 6, 4], [1, 5, 7], [1, 7, 3]])
    return spatial.in_mesh(lake.points(spark, d), v, f).select("point_id")


def clusters(spark, d):
    sim = network.connectivity_similarity(spark, d)
    return clustering.clusters(clustering.to_distance(sim, "matching_index_synapses"), 5)


def labels(spark, d):
    part = lake.table(spark, d, "part")
    out = text.label("%0 (%1) - %2", {"0": F.col("p_name"), "1": F.when(F.col("p_size") > 25, F.col("p_brand")), "2": F.col("p_type")})
    return part.select("p_partkey", out.alias("label"))


def tiles(spark, d):
    n = lake.nodes(spark, d)
    boxes = n.select(F.col("node_id").alias("box_id"), F.col("y").alias("x1"), (F.col("y") + 500).alias("x2"), (F.col("x") * 100).alias("y1"), (F.col("x") * 100 + 300).alias("y2"), F.col("z").alias("z1"), (F.col("z") + 40).alias("z2"))
    return spatial.tiles(boxes, 64, 64, (4, 4, 40))


def diff(spark, d):
    n = lake.nodes(spark, d)
    new = n.where("node_id % 10 <> 3").withColumn("x", F.when(F.col("node_id") % 10 == 4, F.col("x") - 1).otherwise(F.col("x"))).unionByName(n.where("node_id < 5").withColumn("node_id", F.col("node_id") + 10_000_000))
    return mutate.diff_nodes(n, new)


def updated(spark, d):
    n = lake.nodes(spark, d).select("node_id", "radius", "confidence")
    return mutate.update(n, n.where("node_id % 3 = 0").select("node_id", (F.col("radius") * 2).alias("radius")), "node_id")


def changes(spark, d):
    e = network.edge_table(spark, d)
    after = e.where("source % 10 <> 1").withColumn("weight", F.when(F.col("target") % 10 == 2, F.col("weight") + 1).otherwise(F.col("weight")))
    return live.network_changes(e, after)


def landmarks(spark, d):
    p = lake.table(spark, d, "supplier").select((F.col("s_nationkey") % 2).cast("string").alias("grp"), F.col("s_nationkey").cast("int").alias("k"), F.col("s_acctbal").alias("x"), F.col("s_suppkey").cast("double").alias("y"), F.lit(0.0).alias("z"))
    loc = p.select("grp", F.floor(F.col("y") / 2).alias("landmark"), "x", "y", "z")
    return text.match_landmarks(loc.select("grp", "landmark"), loc, "0", "1")


def in_box(spark, d):
    return lake.nodes(spark, d).where(spatial.in_box((10, 900, 0), (40, 1200, 1e9))).select("node_id")


def virtual(spark, d):
    return _round(spatial.virtual_nodes(lake.nodes(spark, d), 40.0), "x", "y", "z")


def _synapses(spark, d):
    return lake.table(spark, d, "lineitem").select(F.col("l_partkey").alias("node_id"), F.when(F.col("l_returnflag") == "A", "presynaptic_to").otherwise("postsynaptic_to").alias("relation"))


def flow(spark, d):
    return trees.flow(lake.nodes(spark, d), _synapses(spark, d))


def bending(spark, d):
    n = lake.nodes(spark, d)
    return trees.bending_flow(n, trees.flow(n, _synapses(spark, d)))


def split(spark, d):
    n = lake.nodes(spark, d)
    return trees.split_axon(n, trees.flow(n, _synapses(spark, d)))


def segregation(spark, d):
    part = lake.table(spark, d, "part").select(F.col("p_partkey").alias("node_id"), (F.col("p_size") % 3).alias("root"), F.col("p_brand").alias("part"))
    both = part.join(_synapses(spark, d), "node_id")
    parts = both.groupBy("root", "part").agg(F.count_if(F.col("relation") == "presynaptic_to").alias("pre"), F.count_if(F.col("relation") == "postsynaptic_to").alias("post"))
    return _round(trees.segregation(parts), "index")


def downsampled(spark, d):
    return trees.downsample(_chains(spark, d), 3).select("node_id", "parent_id")


def despiked(spark, d):
    return _round(trees.despike(_chains(spark, d).withColumn("x", F.when(F.col("node_id") % 5 == 1, 20.0).otherwise(0.0))).select("node_id", "x", "y"), "x", "y")


def radii(spark, d):
    return _round(trees.guess_radius(_chains(spark, d).withColumn("radius", F.when(F.col("node_id") % 3 > 0, -1.0).otherwise(F.col("y") + 1))).select("node_id", "radius"), "radius")


def healed(spark, d):
    """Chains whose turns lie near those of the conversation before: what comes within reach is one tree."""
    n = _chains(spark, d).withColumn("x", (F.col("conv_id") + F.floor(F.col("conv_id") / 5) * 5).cast("double"))
    return trees.fragments(trees.heal(n, 1.0)).groupBy("root").agg(F.count("*").alias("n")).select("n")


def scaled(spark, d):
    n = lake.nodes(spark, d).withColumn("radius", F.when(F.col("radius") < 5, -1.0).otherwise(F.col("radius")))
    return _round(trees.scaled(n, 2.5).select("node_id", "x", "y", "z", "radius"), "y")


def equal(spark, d):
    n = lake.treenodes(spark, d)
    return trees.equal_neurons(n, n.withColumn("x", F.when((F.col("skeleton_id") % 2 == 1) & (F.col("x") == 1), -1.0).otherwise(F.col("x"))))


def placement_clusters(spark, d):
    sim = spatial.mutual(spatial.synapse_similarity(_neurons(spark, d), 0.1, 0.2))
    return clustering.clusters(clustering.to_distance(sim, "similarity"), 3, "average")


def _tree(f):
    return lambda spark, d: f(lake.nodes(spark, d))


QUERIES = {
    "classify_nodes": _tree(trees.classify), "node_children": _tree(lambda n: trees.children(n).select("node_id", F.array_join("children", ",").alias("children"))),
    "node_depths": _tree(lambda n: _round(trees.depths(n), "distance")), "cable_length": _tree(lambda n: _round(trees.cable(n), "cable", digits=3)),
    "arbor_confidence": _tree(lambda n: _round(trees.arbor_confidence(n), "arbor_confidence", digits=9)), "strahler": strahler,
    "subtree": lambda s, d: trees.subtree(lake.nodes(s, d), _top(s, 5)), "cut_distal": lambda s, d: trees.cut_distal(lake.nodes(s, d), _top(s, 5)).select("node_id", "parent_id"), "cut_proximal": lambda s, d: trees.cut_proximal(lake.nodes(s, d), _top(s, 5)).select("node_id", "parent_id"),
    "small_segments": _tree(lambda n: trees.small_segments(n).select("node_id", "segment")), "segment_lengths": _tree(lambda n: _round(trees.segment_lengths(n), "length")), "prune_by_length": _tree(lambda n: trees.prune_by_length(n, 700.0).select("node_id", "parent_id")),
    "chain_depths": lambda s, d: trees.depths(_chains(s, d)), "reroot": lambda s, d: trees.reroot(lake.nodes(s, d), 77).select("node_id", "parent_id"), "geodesic": lambda s, d: _round(trees.geodesic(lake.nodes(s, d), _pairs(s, d)), "distance"), "geodesic_segments": geodesic_segments,
    "connection_density": density, "longest_path": _tree(lambda n: _round(trees.longest_path(n), "distance")), "swc": _tree(lambda n: trees.to_swc(n).select("node", "parent", "z")),
    "nodes_in_bbox": in_box, "nearest_points": nearest, "points_within": within, "predict_connectivity": predicted, "synapse_similarity": placement, "contact_radius": radius, "in_mesh": mesh, "virtual_nodes": virtual,
    "flow_centrality": flow, "bending_flow": bending, "axon_dendrite_split": split, "segregation_index": segregation, "fragments": lambda s, d: trees.fragments(_chains(s, d)), "downsample": downsampled, "despike": despiked, "guess_radius": radii, "heal": healed,
    "longest_neurite": _tree(trees.longest_neurite), "scale_neurons": scaled, "equal_neurons": equal, "cluster_by_synapse_placement": placement_clusters,
    "cluster_by_connectivity": clusters, "neuron_labels": labels, "image_tiles": tiles, "diff_nodes": diff, "update_radii": updated, "network_changes": changes, "match_landmarks": landmarks,
}

PTS = "p AS (SELECT vec_id AS point_id, label AS kind, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)"
CHAIN = "c AS (SELECT DISTINCT conv_id, turn, conv_id * 100000 + turn AS node_id FROM conversations), ch AS (SELECT conv_id, turn, c.node_id, p.node_id AS parent_id, k.node_id AS child FROM c LEFT JOIN (SELECT node_id FROM c) p ON p.node_id = c.node_id - 1 LEFT JOIN (SELECT node_id FROM c) k ON k.node_id = c.node_id + 1), run AS (SELECT *, node_id - row_number() OVER (ORDER BY node_id) AS chain FROM ch), links_at AS (SELECT *, row_number() OVER (PARTITION BY chain ORDER BY node_id) - 1 AS hops, count(*) OVER (PARTITION BY chain) - 1 AS low FROM run)"
KIND = "k AS (SELECT n.node_id, n.parent_id, coalesce(c, 0) AS c FROM n LEFT JOIN (SELECT parent_id AS node_id, count(*) AS c FROM n GROUP BY 1) USING (node_id)), w AS (SELECT node_id, node_id AS segment, parent_id FROM k WHERE parent_id IS NOT NULL AND c <> 1 UNION ALL SELECT k.node_id, w.segment, k.parent_id FROM w JOIN k ON k.node_id = w.parent_id WHERE k.c = 1 AND k.parent_id IS NOT NULL)"
ANCESTORS = "an AS (SELECT node_id, node_id AS a FROM n UNION ALL SELECT an.node_id, n.parent_id FROM an JOIN n ON n.node_id = an.a WHERE n.parent_id IS NOT NULL)"
SEGMENTS = f"{ANCESTORS}, seg AS (SELECT a AS node_id, arg_max(an.node_id, (r.distance, -an.node_id)) AS segment FROM an JOIN r ON r.node_id = an.node_id GROUP BY 1)"
FLOW = f"{ANCESTORS}, syn AS (SELECT l_partkey AS node_id, count(*) FILTER (l_returnflag = 'A') AS pre, count(*) FILTER (l_returnflag <> 'A') AS post FROM lineitem GROUP BY 1), below AS (SELECT a AS node_id, CAST(coalesce(sum(pre), 0) AS DOUBLE) AS pre, CAST(coalesce(sum(post), 0) AS DOUBLE) AS post FROM an LEFT JOIN syn USING (node_id) GROUP BY 1), al AS (SELECT pre AS p, post AS q FROM below WHERE node_id = 0), fl AS (SELECT node_id, 0::BIGINT AS root, pre AS pre_below, post AS post_below, (q - post) * pre AS centrifugal, (p - pre) * post AS centripetal, (q - post) * pre + (p - pre) * post AS flow FROM below, al)"
DIST = "sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2)"
SQL = {
    "classify_nodes": f"WITH {NODES} SELECT n.node_id, CASE WHEN parent_id IS NULL THEN 'root' WHEN coalesce(k, 0) = 0 THEN 'end' WHEN k = 1 THEN 'slab' ELSE 'branch' END AS type FROM n LEFT JOIN (SELECT parent_id AS node_id, count(*) AS k FROM n GROUP BY 1) c USING (node_id)",
    "node_children": f"WITH {NODES} SELECT parent_id AS node_id, string_agg(CAST(node_id AS VARCHAR), ',' ORDER BY node_id) AS children FROM n WHERE parent_id IS NOT NULL GROUP BY 1",
    "node_depths": f"WITH RECURSIVE {UP} SELECT node_id, CAST(0 AS BIGINT) AS root, hops, round(distance, 6) AS distance FROM r",
    "cable_length": f"WITH {NODES} SELECT round(sum(length), 3) AS cable FROM e",
    "arbor_confidence": f"WITH RECURSIVE {NODES}, r AS (SELECT node_id, 1.0::DOUBLE AS c FROM n WHERE parent_id IS NULL UNION ALL SELECT n.node_id, r.c * ([1.0, 0.9, 0.6, 0.4, 0.2][6 - n.confidence])::DOUBLE FROM n JOIN r ON n.parent_id = r.node_id) SELECT node_id, round(c, 9) AS arbor_confidence FROM r",
    "subtree": f"WITH RECURSIVE {NODES}, r AS (SELECT 5::BIGINT AS node_id UNION ALL SELECT n.node_id FROM n JOIN r ON n.parent_id = r.node_id) SELECT node_id FROM r",
    "cut_distal": f"WITH RECURSIVE {NODES}, r AS (SELECT 5::BIGINT AS node_id UNION ALL SELECT n.node_id FROM n JOIN r ON n.parent_id = r.node_id) SELECT node_id, parent_id FROM n WHERE node_id = 5 OR node_id NOT IN (SELECT node_id FROM r)",
    "cut_proximal": f"WITH RECURSIVE {NODES}, r AS (SELECT 5::BIGINT AS node_id UNION ALL SELECT n.node_id FROM n JOIN r ON n.parent_id = r.node_id) SELECT node_id, CASE WHEN node_id <> 5 THEN parent_id END AS parent_id FROM n WHERE node_id IN (SELECT node_id FROM r)",
    "chain_depths": "WITH RECURSIVE c AS (SELECT DISTINCT conv_id * 100000 + turn AS node_id FROM conversations), r AS (SELECT node_id, node_id AS root, 0 AS hops FROM c WHERE node_id - 1 NOT IN (SELECT node_id FROM c) UNION ALL SELECT c.node_id, r.root, r.hops + 1 FROM c JOIN r ON c.node_id = r.node_id + 1) SELECT node_id, root, hops, CAST(hops AS DOUBLE) AS distance FROM r",
    "reroot": f"WITH RECURSIVE {NODES}, w AS (SELECT 77::BIGINT AS node_id, NULL::BIGINT AS p UNION ALL SELECT n.parent_id, w.node_id FROM w JOIN n USING (node_id) WHERE n.parent_id IS NOT NULL) SELECT n.node_id, CASE WHEN w.node_id IS NOT NULL THEN w.p ELSE n.parent_id END AS parent_id FROM n LEFT JOIN w USING (node_id)",
    "geodesic": f"WITH RECURSIVE {UP}, an AS (SELECT node_id, node_id AS a FROM n WHERE node_id < 60 UNION ALL SELECT an.node_id, n.parent_id FROM an JOIN n ON n.node_id = an.a WHERE n.parent_id IS NOT NULL), l AS (SELECT x.node_id AS a, y.node_id AS b, max(r.distance) AS lca FROM an x JOIN an y ON x.a = y.a AND x.node_id < y.node_id JOIN r ON r.node_id = x.a GROUP BY 1, 2) SELECT a, b, round(p.distance + q.distance - 2 * lca, 6) AS distance FROM l JOIN r p ON p.node_id = a JOIN r q ON q.node_id = b",
    "strahler": f"WITH RECURSIVE {UP}, st AS (SELECT hops, node_id, parent_id, 1 AS s FROM r WHERE hops = (SELECT max(hops) FROM r) UNION ALL SELECT r.hops, r.node_id, r.parent_id, coalesce(t, 1) FROM r LEFT JOIN (SELECT p, l[1] + CASE WHEN len(l) > 1 AND l[1] = l[2] THEN 1 ELSE 0 END AS t FROM (SELECT parent_id AS p, list_reverse_sort(list(s)) AS l FROM st GROUP BY 1)) ON p = r.node_id WHERE r.hops = (SELECT max(hops) - 1 FROM st)) SELECT node_id, CAST(s AS INT) AS strahler FROM st",
    "small_segments": f"WITH RECURSIVE {NODES}, {KIND} SELECT node_id, segment FROM w",
    "geodesic_segments": f"WITH RECURSIVE {UP}, {KIND} SELECT w.node_id AS a, segment AS b, round(q.distance - p.distance, 6) AS distance FROM w JOIN r p ON p.node_id = w.node_id JOIN r q ON q.node_id = segment",
    "segment_lengths": f"WITH RECURSIVE {UP}, {SEGMENTS} SELECT segment, count(*) AS n_nodes, round(sum(length), 6) AS length FROM seg JOIN e USING (node_id) GROUP BY 1",
    "prune_by_length": f"WITH RECURSIVE {UP}, {SEGMENTS}, bad AS (SELECT segment FROM seg JOIN e USING (node_id) GROUP BY 1 HAVING sum(length) < 700), kept AS (SELECT node_id, parent_id FROM n JOIN seg USING (node_id) WHERE parent_id IS NULL OR segment NOT IN (SELECT segment FROM bad)) SELECT node_id, CASE WHEN parent_id IN (SELECT node_id FROM kept) THEN parent_id END AS parent_id FROM kept",
    "connection_density": f"WITH RECURSIVE {UP}, {ANCESTORS}, l AS (SELECT x.node_id AS a, y.node_id AS b, max(r.distance) AS lca FROM an x JOIN an y ON x.a = y.a AND x.node_id < y.node_id AND x.node_id % 7 = y.node_id % 7 JOIN r ON r.node_id = x.a GROUP BY 1, 2) SELECT a % 7 AS grp, round(1000.0 / median(p.distance + q.distance - 2 * lca), 6) AS density FROM l JOIN r p ON p.node_id = a JOIN r q ON q.node_id = b GROUP BY 1",
    "swc": f"WITH RECURSIVE {UP}, k AS (SELECT node_id, parent_id, row_number() OVER (ORDER BY hops, node_id) AS i FROM r) SELECT CAST(k.i AS INT) AS node, CAST(coalesce(p.i, -1) AS INT) AS parent, CAST(k.node_id AS DOUBLE) AS z FROM k LEFT JOIN k p ON p.node_id = k.parent_id",
    "virtual_nodes": f"WITH {NODES}, p AS (SELECT a.node_id, a.x AS x0, a.y AS y0, a.z AS z0, b.x AS x1, b.y AS y1, b.z AS z1, CAST(round(abs(b.z - a.z) / 40) AS INT) AS k FROM n a JOIN n b ON a.parent_id = b.node_id), q AS (SELECT *, unnest(range(1, k)) AS step FROM p WHERE k > 1) SELECT node_id, CAST(step AS INT) AS step, round(x0 + step / k * (x1 - x0), 6) AS x, round(y0 + step / k * (y1 - y0), 6) AS y, round(z0 + step / k * (z1 - z0), 6) AS z FROM q",
    "image_tiles": "WITH b AS (SELECT p_partkey AS box_id, CAST(floor(p_retailprice / 4 + 0.5) AS BIGINT) AS x1, CAST(floor((p_retailprice + 500) / 4 + 0.5) AS BIGINT) AS x2, CAST(floor(p_size * 100 / 4 + 0.5) AS BIGINT) AS y1, CAST(floor((p_size * 100 + 300) / 4 + 0.5) AS BIGINT) AS y2, CAST(floor(p_partkey / 40 + 0.5) AS BIGINT) AS z1, CAST(floor((p_partkey + 40) / 40 + 0.5) AS BIGINT) AS z2 FROM part), z AS (SELECT *, unnest(range(z1, z2 + 1)) AS z FROM b), c AS (SELECT *, unnest(range(x1 // 64, x2 // 64 + 1)) AS col FROM z) SELECT box_id, z, unnest(range(y1 // 64, y2 // 64 + 1)) AS row, col, x1 % 64 AS left, y1 % 64 AS top FROM c",
    "match_landmarks": "WITH l AS (SELECT s_nationkey % 2 AS g, s_suppkey // 2 AS landmark, s_acctbal AS x, CAST(s_suppkey AS DOUBLE) AS y, 0.0::DOUBLE AS z FROM supplier), u AS (SELECT g, landmark, any_value(x) AS x, any_value(y) AS y, any_value(z) AS z FROM l GROUP BY 1, 2 HAVING count(*) = 1) SELECT a.landmark, a.x AS x1, a.y AS y1, a.z AS z1, b.x AS x2, b.y AS y2, b.z AS z2 FROM u a JOIN u b ON a.landmark = b.landmark AND a.g = 0 AND b.g = 1",
    "flow_centrality": f"WITH RECURSIVE {NODES}, {FLOW} SELECT * FROM fl",
    "bending_flow": f"WITH RECURSIVE {NODES}, {FLOW} SELECT parent_id AS node_id, sum(pre_below) * sum(post_below) - sum(pre_below * post_below) AS bending FROM fl JOIN n USING (node_id) WHERE parent_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "axon_dendrite_split": f"WITH RECURSIVE {UP}, {FLOW}, m AS (SELECT fl.*, p, q FROM fl JOIN r USING (node_id), al ORDER BY flow DESC, hops, node_id LIMIT 1), far AS (SELECT an.node_id FROM an JOIN m ON an.a = m.node_id), s AS (SELECT coalesce(pre_below / nullif(pre_below + post_below, 0), 0) >= coalesce((p - pre_below) / nullif(p - pre_below + q - post_below, 0), 0) AS distal FROM m) SELECT n.node_id, CASE WHEN (n.node_id IN (SELECT node_id FROM far)) = distal THEN 'axon' ELSE 'dendrite' END AS part FROM n, s",
    "segregation_index": "WITH t AS (SELECT p_size % 3 AS root, p_brand, CAST(count(*) FILTER (l_returnflag = 'A') AS DOUBLE) AS p, CAST(count(*) FILTER (l_returnflag <> 'A') AS DOUBLE) AS q FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1, 2), h AS (SELECT *, CASE WHEN p > 0 AND q > 0 THEN -p / (p + q) * ln(p / (p + q)) - q / (p + q) * ln(q / (p + q)) ELSE 0 END AS h FROM t), a AS (SELECT root, sum((p + q) * h) / sum(p + q) AS s, sum(p) AS p, sum(q) AS q FROM h GROUP BY 1) SELECT root, round(1 - s / (-p / (p + q) * ln(p / (p + q)) - q / (p + q) * ln(q / (p + q))), 6) AS index FROM a",
    "fragments": f"WITH {CHAIN} SELECT node_id, min(node_id) OVER (PARTITION BY chain) AS root FROM links_at",
    "downsample": f"WITH {CHAIN}, s AS (SELECT * FROM links_at WHERE hops = 0 OR hops = low OR (low - hops) % 3 = 0) SELECT node_id, lag(node_id) OVER (PARTITION BY chain ORDER BY hops) AS parent_id FROM s",
    "despike": f"WITH {CHAIN}, p AS (SELECT *, CASE WHEN node_id % 5 = 1 THEN 20.0::DOUBLE ELSE 0 END AS x, CAST(turn AS DOUBLE) AS y FROM links_at), v AS (SELECT *, lag(x) OVER o AS px, lag(y) OVER o AS py, lead(x) OVER o AS qx, lead(y) OVER o AS qy FROM p WINDOW o AS (PARTITION BY chain ORDER BY hops)), f AS (SELECT *, sqrt((x - px) ** 2 + (y - py) ** 2) + sqrt((x - qx) ** 2 + (y - qy) ** 2) > 5 * sqrt((px - qx) ** 2 + (py - qy) ** 2) AS spike FROM v) SELECT node_id, round(CASE WHEN spike THEN (px + qx) / 2 ELSE x END, 6) AS x, round(CASE WHEN spike THEN (py + qy) / 2 ELSE y END, 6) AS y FROM f",
    "guess_radius": f"WITH {CHAIN}, p AS (SELECT *, CASE WHEN node_id % 3 > 0 THEN -1.0::DOUBLE ELSE turn + 1 END AS radius FROM links_at) SELECT node_id, round(CASE WHEN radius <= 0 AND hops > 0 THEN coalesce(avg(CASE WHEN radius > 0 AND hops > 0 THEN radius END) OVER (PARTITION BY chain), radius) ELSE radius END, 6) AS radius FROM p",
    "heal": f"WITH RECURSIVE {CHAIN}, pair AS (SELECT DISTINCT a.chain AS a, b.chain AS b FROM links_at a JOIN links_at b ON a.chain <> b.chain AND sqrt((a.conv_id + a.conv_id // 5 * 5 - b.conv_id - b.conv_id // 5 * 5) ** 2 + (a.turn - b.turn) ** 2) <= 1), reach AS (SELECT DISTINCT chain AS a, chain AS b FROM links_at UNION SELECT reach.a, pair.b FROM reach JOIN pair ON reach.b = pair.a), comp AS (SELECT a AS chain, min(b) AS comp FROM reach GROUP BY 1) SELECT count(*) AS n FROM links_at JOIN comp USING (chain) GROUP BY comp",
    "longest_neurite": f"WITH RECURSIVE {UP}, {ANCESTORS} SELECT a AS node_id FROM an WHERE node_id = (SELECT arg_max(node_id, (distance, -node_id)) FROM r)",
    "scale_neurons": f"WITH {NODES} SELECT node_id, x * 2.5 AS x, round(y * 2.5, 6) AS y, z * 2.5 AS z, CASE WHEN x < 5 THEN -1 ELSE x * 2.5 END AS radius FROM n",
    "equal_neurons": "SELECT CAST(substr(p_brand, 7) AS BIGINT) AS skeleton_id, CAST(substr(p_brand, 7) AS BIGINT) % 2 = 0 OR count(*) FILTER (p_size = 1) = 0 AS equal FROM part GROUP BY 1",
    "longest_path": f"WITH RECURSIVE {UP} SELECT CAST(0 AS BIGINT) AS root, max_by(node_id, distance) AS leaf, round(max(distance), 6) AS distance FROM r",
    "nodes_in_bbox": f"WITH {NODES} SELECT node_id FROM n WHERE x BETWEEN 10 AND 40 AND y BETWEEN 900 AND 1200",
    "nearest_points": f"WITH {PTS}, d AS (SELECT a.point_id AS a, b.point_id AS b, {DIST} AS distance FROM p a JOIN p b ON a.kind = 0 AND b.kind = 1) SELECT a, b, round(distance, 9) AS distance FROM d WHERE distance <= 0.15 QUALIFY row_number() OVER (PARTITION BY a ORDER BY distance, b) = 1",
    "points_within": f"WITH {PTS} SELECT a.point_id AS a, b.point_id AS b FROM p a JOIN p b ON a.kind = 2 AND b.kind = 3 WHERE {DIST} <= 0.1",
    "predict_connectivity": f"WITH {PTS} SELECT a.kind AS source, b.kind AS target, count(DISTINCT a.point_id) AS weight FROM p a JOIN p b ON a.kind < 5 AND b.kind >= 5 WHERE {DIST} < 0.08 GROUP BY 1, 2",
    "synapse_similarity": f"WITH {PTS}, s AS (SELECT *, point_id % 6 AS neuron FROM p), own AS (SELECT a.point_id, count(*) FILTER ({DIST} <= 0.2) AS dense FROM s a JOIN s b USING (neuron, kind) GROUP BY 1), m AS (SELECT a.point_id, a.neuron AS na, b.neuron AS nb, min({DIST}) AS d, arg_min(b.point_id, ({DIST}, b.point_id)) AS n FROM s a JOIN s b ON a.kind = b.kind GROUP BY 1, 2, 3), t AS (SELECT na, nb, sum(exp(-abs(x.dense - y.dense) / (x.dense + y.dense)) * exp(-d * d / (2 * 0.1 * 0.1))) AS v FROM m JOIN own x ON x.point_id = m.point_id JOIN own y ON y.point_id = m.n GROUP BY 1, 2), z AS (SELECT neuron, count(*) AS k FROM s GROUP BY 1) SELECT x.neuron AS a, y.neuron AS b, round(coalesce(v, 0) / x.k, 6) AS similarity FROM z x CROSS JOIN z y LEFT JOIN t ON na = x.neuron AND nb = y.neuron",
    "contact_radius": f"WITH {NODES} SELECT round(count(*) / sum(1 / length) + 2 * (quantile_cont(length, 0.75) - quantile_cont(length, 0.25)), 4) AS radius FROM e WHERE length > 0",
    "in_mesh": f"WITH {PTS} SELECT point_id FROM p WHERE x BETWEEN -0.1 AND 0.1 AND y BETWEEN -0.1 AND 0.1 AND z BETWEEN -0.1 AND 0.1",
    "neuron_labels": "SELECT p_partkey, p_name || CASE WHEN p_size > 25 THEN ' (' || p_brand ELSE '' END || ') - ' || p_type AS label FROM part",
    "diff_nodes": "SELECT p_partkey AS node_id, CASE p_partkey % 10 WHEN 3 THEN 'deleted' WHEN 4 THEN 'moved' ELSE 'mutual' END AS state FROM part UNION ALL SELECT p_partkey + 10000000, 'added' FROM part WHERE p_partkey < 5",
    "update_radii": "SELECT p_partkey AS node_id, CAST(p_size AS DOUBLE) * CASE WHEN p_partkey % 3 = 0 THEN 2 ELSE 1 END AS radius, CAST(p_partkey % 5 + 1 AS INT) AS confidence FROM part",
    "network_changes": f"WITH {network.CTE} SELECT source, target, 'gone' AS change, NULL::BIGINT AS weight FROM edges WHERE source % 10 = 1 UNION ALL SELECT source, target, 'changed', weight + 1 FROM edges WHERE source % 10 <> 1 AND target % 10 = 2",
}
