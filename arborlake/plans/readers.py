"""Queries of readers, connectors and annotations over the star-schema views, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotations as a
from ..operators import connectivity
from ..operators import connectors as c
from ..operators import readers as r
from ..sources import lake

ALL = ("treenodes", "reviews", "tags", "users", "skeletons", "placed_connectors", "node_links")


def _t(spark, d, *names):
    return [getattr(lake, n)(spark, d) for n in names]


def _written(df, *columns):
    """Arrays as text, so that results compare column by column."""
    return df.withColumns({x: F.array_join(F.transform(x, lambda v: v.cast("string")), ",") for x in columns})


def _ids(df, key, where, as_key=None):
    return df.where(where).select(F.col(key).alias(as_key or key))


def node_table(s, d):
    return _written(r.node_table(*_t(s, d, "treenodes", "reviews", "tags", "users")), "reviewers", "tags")


def node_details(s, d):
    out = r.node_details(*_t(s, d, "treenodes", "reviews", "users"))
    return out.withColumn("review_times", F.size("review_times").cast("long")).withColumn("reviewers", F.array_join(F.transform("reviewers", lambda v: v.cast("string")), ","))


def node_info(s, d):
    n, k = _t(s, d, "treenodes", "skeletons")
    return r.node_info(n, k, n.where("confidence = 3"))


def node_location(s, d):
    n, cn = _t(s, d, "treenodes", "placed_connectors")
    ids = lake.table(s, d, "lineitem").select((F.col("l_partkey") * 2).alias("node_id")).distinct().select((-F.col("node_id")).alias("pos"), "node_id")
    return r.node_locations(n, cn, ids)


def skid_from_node(s, d):
    (n,) = _t(s, d, "treenodes")
    return r.skeletons_of_nodes(n, n.select((F.col("node_id") * 2).alias("node_id")))


def find_nodes(s, d):
    n, t = _t(s, d, "treenodes", "tags")
    return r.find_nodes(n, t, ["AF", "soma"], None, n.where("skeleton_id < 10")).select("node_id", "skeleton_id")


def box_of_nodes(s, d):
    n, cn = _t(s, d, "treenodes", "placed_connectors")
    return r.in_box(n, cn, ((2, 225, 0), (10, 300, 1e6)), "PIXEL").select("kind", "id", "skeleton_id")


def node_tags(s, d):
    return _written(r.tags_of(lake.tags(s, d), "node"), "tags")


def connector_tag_lists(s, d):
    return _written(r.tags_of(lake.tags(s, d), "connector"), "tags")


def label_list(s, d):
    return r.label_list(*_t(s, d, "tags", "treenodes"))


def names(s, d):
    k, n = _t(s, d, "skeletons", "treenodes")
    return r.names(k, n.where("radius > 49"))


def neuron_ids(s, d):
    return r.neuron_ids(lake.skeletons(s, d))


def neuron_exists(s, d):
    return r.exists(lake.skeletons(s, d), lake.table(s, d, "customer").select(F.col("c_custkey").alias("skeleton_id")))


def import_info(s, d):
    out = r.import_info(lake.treenodes(s, d).withColumn("imported", F.col("confidence") == 2), with_nodes=True)
    return out.withColumn("imported_nodes", F.expr("aggregate(imported_nodes, 0L, (s, x) -> s + x)"))


def _origin(s, d):
    return lake.table(s, d, "supplier").select(F.col("s_suppkey").alias("skeleton_id"), (F.col("s_suppkey") * 3).alias("source_id"), F.concat(F.lit("https://example.org/"), F.col("s_nationkey") % 3).alias("source_url"), (F.col("s_nationkey") % 2).alias("source_project_id"))


def origin(s, d):
    return r.origins(_origin(s, d), _ids(lake.table(s, d, "supplier"), "s_suppkey", "s_acctbal > 0", "skeleton_id"))


def skids_by_origin(s, d):
    return r.skeletons_by_origin(_origin(s, d), lake.table(s, d, "customer").select(F.col("c_custkey").alias("source_id")), "https://example.org/1", 1)


def skeleton_change(s, d):
    h = lake.table(s, d, "lineitem").select(F.col("l_partkey").alias("node_id"), (F.col("l_suppkey") % 10).alias("skeleton_id"), (F.col("l_orderkey") % 10).alias("new_skeleton_id"), F.col("l_shipdate").cast("timestamp_ntz").alias("changed"))
    return r.skeleton_changes(h)


def neurons_in_bbox(s, d):
    out = r.skeletons_in_box(lake.treenodes(s, d), ((10, 900, 0), (40, 1e6, 1e9)), min_nodes=20, min_cable=100.0)
    return out.withColumn("cable", F.round("cable", 3))


def neurons_in_volume(s, d):
    n, t, k = _t(s, d, "treenodes", "tags", "skeletons")
    soma = r.has_soma(n, t, k, min_radius=25.0).where("has_soma")
    return r.skeletons_in_volumes(n, [((0, 0, 0), (20, 1e6, 1e9)), ((15, 0, 0), (50, 1000, 1e9)), ((0, 905, 0), (50, 1e6, 500))], min_nodes=9, intersect=True, somas=soma)


def skeletons_by_criteria(s, d):
    n, v = _t(s, d, "treenodes", "reviews")
    return r.skeleton_ids(n, v, created_by=3, reviewed_by=4, since="2020-01-05", until="2020-03-01")


def skeletons_by_size(s, d):
    return r.skeleton_ids(lake.treenodes(s, d), created_by=3, nodecount_gt=75)


def has_soma(s, d):
    n, t, k = _t(s, d, "treenodes", "tags", "skeletons")
    return _written(r.has_soma(n, t, k, min_radius=45.0, return_ids=True), "somas")


def user_list(s, d):
    return r.user_list(lake.users(s, d))


def transactions(s, d):
    log = lake.table(s, d, "events").select(F.col("event_id").alias("transaction_id"), (F.col("user_id") % 30).alias("user_id"), F.col("event_type").alias("label"), F.col("ts").cast("timestamp_ntz").alias("executed"))
    return r.transactions(log, lake.users(s, d), 10, 40)


def sampler_counts(s, d):
    sampler = lake.table(s, d, "orders").select(F.col("o_orderkey").alias("sampler_id"), (F.col("o_custkey") % 40).alias("skeleton_id"))
    return r.sampler_counts(sampler, lake.table(s, d, "customer").select((F.col("c_custkey") % 50).alias("skeleton_id")))


def samplers(s, d):
    sampler = lake.table(s, d, "orders").select(F.col("o_orderkey").alias("sampler_id"), F.col("o_custkey").alias("skeleton_id"), (F.col("o_orderkey") * 60).alias("created"))
    return r.samplers(sampler, lake.table(s, d, "supplier").select(F.col("s_suppkey").alias("skeleton_id"))).withColumn("created", F.unix_seconds("created"))


def sampler_domains(s, d):
    domains = lake.table(s, d, "lineitem").select((F.col("l_orderkey") % 100).alias("sampler_id"), F.col("l_partkey").alias("start_node_id"))
    return r.sampler_domains(domains, 7)


def get_neuron(s, d):
    n, k, cn, t, sk = _t(s, d, "treenodes", "node_links", "placed_connectors", "tags", "skeletons")
    out = r.neurons(n, k, cn, t, sk)
    size = lambda x: F.coalesce(F.size(x), F.lit(0)).cast("long")
    roots = F.size(F.filter("nodes", lambda v: v["parent_id"] == -1)).cast("long")
    return out.select("skeleton_id", "name", size("nodes").alias("n_nodes"), size("connectors").alias("n_connectors"), size("tags").alias("n_tags"), roots.alias("n_roots"), F.expr("aggregate(connectors, 0L, (s, c) -> s + c.connector_id * (c.type + 1))").alias("connectors"), F.expr("aggregate(nodes, 0L, (s, n) -> s + n.node_id * n.confidence)").alias("nodes"))


def missing_neurons(s, d):
    return r.missing(lake.skeletons(s, d), lake.table(s, d, "supplier").select(F.col("s_suppkey").alias("skeleton_id")))


def get_arbor(s, d):
    k = lake.node_links(s, d)
    return r.arbor_partners(k, lake.table(s, d, "supplier").select(F.col("s_suppkey").alias("skeleton_id"))).groupBy("skeleton_id", "relation", "other_relation").agg(F.count("*").alias("n"), F.sum("other_node_id").alias("others"))


def get_history(s, d):
    out = r.user_history(*_t(s, d, "treenodes", "node_links", "reviews"), "1998-01-01", "2021-01-01")
    return out.withColumn("cable", F.round("cable", 3))


def user_totals(s, d):
    out = r.user_totals(*_t(s, d, "treenodes", "node_links", "reviews"), "1998-01-01", "2021-01-01")
    return out.withColumn("cable", F.round("cable", 3))


def user_actions(s, d):
    n, k, v, u = _t(s, d, "treenodes", "node_links", "reviews", "users")
    return r.user_actions(n, k, v, u, u.where("user_id % 3 = 1"), n.where("skeleton_id % 2 = 0")).groupBy("user", "action").agg(F.count("*").alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))


def review_details(s, d):
    v, n, u = _t(s, d, "reviews", "treenodes", "users")
    return r.review_details(v, n, u, [1, 2, 3]).toDF("node_id", "skeleton_id", "u1", "u2", "u3")


def get_connectors(s, d):
    cn, k, u, t = _t(s, d, "placed_connectors", "node_links", "users", "tags")
    tagged = t.where("kind = 'connector' AND tag = 'P'").select(F.col("node_id").alias("connector_id"))
    return c.connectors_of(cn, k, u, _ids(lake.table(s, d, "supplier"), "s_suppkey", "s_nationkey < 5", "skeleton_id"), "postsynaptic_to", tagged)


def connectors_in_bbox(s, d):
    return c.connectors_in_box(*_t(s, d, "placed_connectors", "node_links"), ((10_000, 0, 0), (100_000, 200, 24)), "PIXEL")


def connectors_in_bbox_links(s, d):
    return c.connectors_in_box(*_t(s, d, "placed_connectors", "node_links"), ((40_000, 0, 0), (300_000, 500, 900)), give="LINKS").groupBy("relation").agg(F.count("*").alias("n"), F.sum("node_id").alias("nodes"))


def connector_nodes(s, d):
    return _written(c.connector_nodes(lake.node_links(s, d)), "postsynaptic_to", "postsynaptic_to_node")


def links_between(s, d):
    cn, k, n = _t(s, d, "placed_connectors", "node_links", "treenodes")
    seg = lake.table(s, d, "customer")
    out = c.links_between(cn, k, n, _ids(seg, "c_custkey", "c_nationkey = 5", "skeleton_id"), _ids(seg, "c_custkey", "c_nationkey < 5", "skeleton_id"), directional=False)
    return out.select("connector_id", "source_neuron", "target_neuron", "node1_id", "node2_id", "confidence2", F.col("connector_loc.x").alias("cx"), F.col("node2_loc.y").alias("y2"))


def link_tags(s, d):
    k, t = _t(s, d, "node_links", "tags")
    return c.link_tags(k, t, _ids(lake.table(s, d, "supplier"), "s_suppkey", "s_nationkey < 5", "skeleton_id")).groupBy(F.array_join("tags", ",").alias("tags"), "relation").agg(F.count("*").alias("n"))


def _fragments(s, d):
    """Links whose neurons fall into fragments by node."""
    return lake.node_links(s, d).withColumn("fragment_id", F.col("skeleton_id") * 3 + F.col("node_id") % 3)


def adjacency_fragments(s, d):
    return c.adjacency_from_connectors(_fragments(s, d))


def edges_from_connectors(s, d):
    cust = lake.table(s, d, "customer")
    return c.edges_of(lake.node_links(s, d), a=_ids(cust, "c_custkey", "c_nationkey < 9", "skeleton_id"), b=_ids(lake.table(s, d, "supplier"), "s_suppkey", "s_acctbal > 0", "skeleton_id"))


def partners_fragments(s, d):
    k = _fragments(s, d)
    return c.partners_from_connectors(k, k.where("skeleton_id % 20 = 3"), parts=connectivity.places(s, k.count()))


def partners_in_volume(s, d):
    cn, k = _t(s, d, "placed_connectors", "node_links")
    sizes = k.groupBy("skeleton_id").agg(F.count("*").alias("num_nodes"))
    found = c.connectors_in_box(cn, k, ((0, 0, 0), (200_000, 1e6, 500)), give="IDS")
    return c.partners_within(k, found, _ids(lake.table(s, d, "supplier"), "s_suppkey", "s_acctbal > 0", "skeleton_id"), sizes, 2, 12)


def _notes(s, d):
    return lake.entities(s, d).where("kind = 'annotation'").select(F.col("entity_id").alias("annotation_id"), "name")


def annotation_table(s, d):
    return _written(a.annotation_table(_notes(s, d), lake.marks(s, d)), "users")


def annotation_ids(s, d):
    return a.annotation_ids(_notes(s, d), ["/[a-e].*", "meta 2", "nothing", "~click"])


def annotation_details(s, d):
    out = a.annotation_details(lake.marks(s, d), _notes(s, d), lake.users(s, d))
    return out.groupBy("annotation", "user").agg(F.count("*").alias("n"), F.min("time_annotated").alias("first"), F.max("time_annotated").alias("last"))


def annotations_of_users(s, d):
    return a.user_annotations(lake.marks(s, d), _notes(s, d), lake.users(s, d).where("user_id < 12"))


def entities_selected(s, d):
    notes = _notes(s, d)
    return a.select_entities(lake.marks(s, d).where("user_id = 7"), lake.entities(s, d), a.nested_ids(notes, [["click", "purchase"], ["view", "error"]]), a.nested_ids(notes, [["signup"]]), ("neuron",))


def entities_below(s, d):
    return a.select_entities(lake.marks(s, d), lake.entities(s, d), below=s.range(3, 4).select(F.col("id").alias("annotation_id")), annotated=s.range(3, 4).select(F.lit(0).alias("clause"), F.col("id").alias("annotation_id")))


def entity_edges(s, d):
    return a.entity_edges(lake.marks(s, d), lake.entities(s, d), by_name=True)


def ambiguous_names(s, d):
    return a.ambiguous_names(lake.entities(s, d))


def annotation_graph(s, d):
    owned = lake.entities(s, d).where("kind = 'neuron'").select(F.col("entity_id").alias("neuron_id"), F.explode(F.expr("sequence(0L, entity_id % 2)")).alias("i")).select("neuron_id", (F.col("neuron_id") * 10 + F.col("i")).alias("skeleton_id"))
    return a.to_skeletons(a.entity_edges(lake.marks(s, d), lake.entities(s, d)), owned, single=True)


def annotations_by_annotation(s, d):
    return a.annotations_under(lake.marks(s, d), lake.entities(s, d), 3, closure=True)


def annotations_by_user(s, d):
    return a.annotations_by_user(lake.marks(s, d), 0)


QUERIES = {
    "get_node_table": node_table, "get_node_details": node_details, "get_node_info": node_info, "get_node_location": node_location, "get_skid_from_node": skid_from_node, "find_nodes": find_nodes, "get_nodes_in_volume": box_of_nodes,
    "get_node_tags": node_tags, "get_connector_tags": connector_tag_lists, "get_label_list": label_list, "get_names": names, "get_neuron_id": neuron_ids, "neuron_exists": neuron_exists, "get_import_info": import_info, "get_origin": origin,
    "get_skids_by_origin": skids_by_origin, "get_skeleton_change": skeleton_change, "get_neurons_in_bbox": neurons_in_bbox, "get_neurons_in_volume": neurons_in_volume, "get_skeleton_ids": skeletons_by_criteria, "get_skeleton_ids_by_size": skeletons_by_size,
    "has_soma": has_soma, "get_user_list": user_list, "get_transactions": transactions, "get_sampler": samplers, "get_sampler_domains": sampler_domains, "get_sampler_counts": sampler_counts, "get_neuron": get_neuron, "missing_neurons": missing_neurons, "get_arbor": get_arbor,
    "get_history": get_history, "get_user_stats": user_totals, "get_user_actions": user_actions, "get_review_details": review_details, "get_connectors": get_connectors, "get_connectors_in_bbox": connectors_in_bbox, "get_connectors_in_bbox_links": connectors_in_bbox_links,
    "get_connector_details": connector_nodes, "get_connectors_between": links_between, "get_connector_links_tags": link_tags, "adjacency_from_connectors": adjacency_fragments, "edges_from_connectors": edges_from_connectors, "cn_table_from_connectors": partners_fragments,
    "get_partners_in_volume": partners_in_volume, "get_annotation_table": annotation_table, "get_annotation_id": annotation_ids, "get_annotation_details": annotation_details, "get_user_annotations": annotations_of_users, "get_entities": entities_selected,
    "get_entities_expanded": entities_below, "get_entity_graph": entity_edges, "ambiguous_names": ambiguous_names, "get_annotation_graph": annotation_graph, "annotations_by_annotation": annotations_by_annotation, "annotations_by_user": annotations_by_user,
}

_KIND = "CAST(ascii(event_type) * 100 + length(event_type) AS BIGINT)"
VIEWS = f"""
tn AS (SELECT p_partkey AS node_id, CASE WHEN p_partkey > 0 THEN p_partkey // 2 END AS parent_id, CAST(substr(p_brand, 7) AS BIGINT) AS skeleton_id, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, CAST(p_partkey AS DOUBLE) AS z, CAST(p_size AS DOUBLE) AS radius, CAST(p_partkey % 5 + 1 AS INT) AS confidence, p_partkey % 25 AS creator_id, p_partkey * 7 % 25 AS editor_id, TIMESTAMP '2020-01-01' + to_hours(p_partkey) AS created, TIMESTAMP '2020-01-01' + to_hours(p_partkey) + to_minutes(p_size - 20) AS edited FROM part),
te AS (SELECT a.*, coalesce(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2), 0) AS length FROM tn a LEFT JOIN tn b ON a.parent_id = b.node_id),
rv AS (SELECT DISTINCT l_partkey AS node_id, l_suppkey % 25 AS reviewer_id, l_shipdate AS reviewed FROM lineitem),
tg AS (SELECT CAST(ascii(tag) * 1000 + length(tag) AS BIGINT) AS label_id, tag, node_id, kind FROM (SELECT l_returnflag || l_linestatus AS tag, l_partkey AS node_id, 'node' AS kind FROM lineitem UNION SELECT o_orderstatus, o_orderkey, 'connector' FROM orders UNION SELECT 'soma', p_partkey, 'node' FROM part WHERE p_partkey % 5 = 0)),
us AS (SELECT CAST(n_nationkey AS BIGINT) AS user_id, lower(n_name) AS login, CASE WHEN n_nationkey % 3 > 0 THEN n_name END AS full_name, split_part(n_name, '_', 1) AS first_name, CASE WHEN n_nationkey % 2 = 0 THEN split_part(n_name, '_', 2) END AS last_name FROM nation),
sk AS (SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS skeleton_id, CAST(substr(p_brand, 7) AS BIGINT) // 2 AS neuron_id, p_brand AS name FROM part),
cn AS (SELECT o_orderkey AS connector_id, o_totalprice AS x, CAST(o_custkey AS DOUBLE) AS y, CAST(o_orderkey % 1000 AS DOUBLE) AS z, o_custkey % 25 AS creator_id, o_orderdate AS created FROM orders),
ln AS (SELECT o_orderkey AS connector_id, o_custkey AS node_id, o_custkey AS skeleton_id, 'presynaptic_to' AS relation, 5 AS confidence, o_custkey % 25 AS creator_id, o_orderdate AS created FROM orders UNION ALL SELECT l_orderkey, l_partkey, l_suppkey, 'postsynaptic_to', (l_linenumber - 1) % 5 + 1, l_suppkey % 25, l_shipdate FROM lineitem),
fr AS (SELECT *, skeleton_id * 3 + node_id % 3 AS fragment_id FROM ln),
meta AS (SELECT {_KIND} % 2 + 1 AS annotation_id, {_KIND} AS entity_id, CAST(0 AS BIGINT) AS user_id, min(ts) AS marked FROM events GROUP BY ALL),
mk AS (SELECT {_KIND} AS annotation_id, user_id + 1000000 AS entity_id, event_id % 25 AS user_id, ts AS marked FROM events UNION ALL SELECT * FROM meta UNION ALL SELECT CAST(3 AS BIGINT), annotation_id, user_id, min(marked) FROM meta GROUP BY ALL),
en AS (SELECT DISTINCT user_id + 1000000 AS entity_id, 'neuron' AS kind, 'neuron ' || CAST(user_id % 100 AS VARCHAR) AS name FROM events UNION ALL SELECT DISTINCT {_KIND}, 'annotation', event_type FROM events UNION ALL SELECT i, 'annotation', 'meta ' || CAST(i AS VARCHAR) FROM (SELECT unnest([1::BIGINT, 2, 3]) AS i)),
nt AS (SELECT entity_id AS annotation_id, name FROM en WHERE kind = 'annotation')"""


def _sql(body, recursive=""):
    return f"WITH {recursive} {VIEWS} {body}"


def _list(expr, order=None, distinct=True):
    return f"coalesce(array_to_string(list_sort({'list_distinct' if distinct else ''}(list({expr}) FILTER ({expr} IS NOT NULL))), ','), '')"


_DAYS = "SELECT creator_id AS user_id, CAST(created AS DATE) AS day, length AS cable, 1 AS nodes, 0 AS links, 0 AS seen FROM te WHERE created >= '1998-01-01' AND created < '2021-01-01' UNION ALL SELECT creator_id, CAST(created AS DATE), 0, 0, 1, 0 FROM ln WHERE created >= '1998-01-01' AND created < '2021-01-01' UNION ALL SELECT reviewer_id, CAST(reviewed AS DATE), 0, 0, 0, 1 FROM rv WHERE reviewed >= '1998-01-01' AND reviewed < '2021-01-01'"
_SUMS = "round(sum(cable), 3) AS cable, CAST(sum(nodes) AS BIGINT) AS n_nodes, CAST(sum(links) AS BIGINT) AS n_links, CAST(sum(seen) AS BIGINT) AS n_reviewed"
_EDGES = "(SELECT connector_id, {0} AS source FROM {1} WHERE relation = 'presynaptic_to'{2}) JOIN (SELECT connector_id, {0} AS target FROM {1} WHERE relation = 'postsynaptic_to'{3}) USING (connector_id)"

SQL = {
    "get_node_table": _sql(f"SELECT skeleton_id, node_id, parent_id AS parent_node_id, confidence, x, y, z, radius, login AS creator, edited AS last_edited, coalesce(rs, '') AS reviewers, coalesce(ts, '') AS tags FROM tn LEFT JOIN us ON user_id = creator_id LEFT JOIN (SELECT node_id, {_list('reviewer_id')} AS rs FROM rv GROUP BY 1) USING (node_id) LEFT JOIN (SELECT node_id, {_list('tag')} AS ts FROM tg WHERE kind = 'node' GROUP BY 1) USING (node_id)"),
    "get_node_details": _sql("SELECT node_id, created AS creation_time, a.login AS creator, edited AS edition_time, b.login AS editor, coalesce(rs, '') AS reviewers, coalesce(k, 0) AS review_times FROM tn LEFT JOIN us a ON a.user_id = creator_id LEFT JOIN us b ON b.user_id = editor_id LEFT JOIN (SELECT node_id, string_agg(CAST(reviewer_id AS VARCHAR), ',' ORDER BY reviewed, reviewer_id) AS rs, count(*) AS k FROM rv GROUP BY 1) USING (node_id)"),
    "get_node_info": _sql("SELECT node_id, skeleton_id, neuron_id, name AS skeleton_name FROM tn JOIN sk USING (skeleton_id) WHERE confidence = 3"),
    "get_node_location": _sql("SELECT -i AS pos, i AS node_id, x, y, z FROM (SELECT DISTINCT l_partkey * 2 AS i FROM lineitem) JOIN (SELECT node_id, x, y, z FROM tn UNION ALL SELECT connector_id, x, y, z FROM cn) ON node_id = i"),
    "get_skid_from_node": _sql("SELECT p_partkey * 2 AS node_id, skeleton_id FROM part LEFT JOIN tn ON node_id = p_partkey * 2"),
    "find_nodes": _sql("SELECT node_id, skeleton_id FROM tn WHERE skeleton_id < 10 AND node_id IN (SELECT node_id FROM tg WHERE kind = 'node' AND tag IN ('AF', 'soma'))"),
    "get_nodes_in_volume": _sql("SELECT * FROM (SELECT 'node' AS kind, node_id AS id, skeleton_id, x, y, z FROM tn UNION ALL SELECT 'connector', connector_id, NULL, x, y, z FROM cn) WHERE x BETWEEN 8 AND 40 AND y BETWEEN 900 AND 1200").replace("SELECT * FROM (SELECT 'node'", "SELECT kind, id, skeleton_id FROM (SELECT 'node'"),
    "get_node_tags": _sql(f"SELECT node_id, {_list('tag')} AS tags FROM tg WHERE kind = 'node' GROUP BY 1"),
    "get_connector_tags": _sql(f"SELECT node_id, {_list('tag')} AS tags FROM tg WHERE kind = 'connector' GROUP BY 1"),
    "get_label_list": _sql("SELECT label_id, tag, skeleton_id, node_id FROM tg JOIN tn USING (node_id) WHERE kind = 'node'"),
    "get_names": _sql("SELECT skeleton_id, name FROM sk WHERE skeleton_id IN (SELECT skeleton_id FROM tn WHERE radius > 49)"),
    "get_neuron_id": _sql("SELECT skeleton_id, neuron_id FROM sk"),
    "neuron_exists": _sql("SELECT c_custkey AS skeleton_id, c_custkey IN (SELECT skeleton_id FROM sk) AS exists FROM customer"),
    "get_import_info": _sql("SELECT skeleton_id, count(*) AS n_nodes, count(*) FILTER (confidence = 2) AS n_imported, CAST(coalesce(sum(node_id) FILTER (confidence = 2), 0) AS BIGINT) AS imported_nodes FROM tn GROUP BY 1"),
    "get_origin": "SELECT s_suppkey AS skeleton_id, s_suppkey * 3 AS source_id, 'https://example.org/' || CAST(s_nationkey % 3 AS VARCHAR) AS source_url, s_nationkey % 2 AS source_project_id FROM supplier WHERE s_acctbal > 0",
    "get_skids_by_origin": "SELECT s_suppkey * 3 AS source_id, s_suppkey AS skeleton_id FROM supplier WHERE s_nationkey % 3 = 1 AND s_nationkey % 2 = 1 AND s_suppkey * 3 IN (SELECT c_custkey FROM customer)",
    "get_skeleton_change": "SELECT l_suppkey % 10 AS skeleton_id, l_orderkey % 10 AS new_skeleton_id, count(*) AS n_nodes, min(l_shipdate) AS first, max(l_shipdate) AS last FROM lineitem WHERE l_suppkey % 10 <> l_orderkey % 10 GROUP BY 1, 2",
    "get_neurons_in_bbox": _sql("SELECT skeleton_id, count(*) AS n_nodes, round(sum(length), 3) AS cable FROM te WHERE x BETWEEN 10 AND 40 AND y >= 900 GROUP BY 1 HAVING count(*) >= 20 AND sum(length) >= 100"),
    "get_neurons_in_volume": _sql("SELECT skeleton_id FROM (SELECT skeleton_id, v FROM (SELECT *, unnest([1, 2, 3]) AS v FROM te) WHERE (v = 1 AND x <= 20) OR (v = 2 AND x >= 15 AND y <= 1000) OR (v = 3 AND y >= 905 AND z <= 500) GROUP BY 1, 2 HAVING count(*) >= 9 AND sum(length) >= 1) WHERE skeleton_id IN (SELECT skeleton_id FROM tn JOIN tg USING (node_id) WHERE tag = 'soma' AND kind = 'node' AND radius >= 25) GROUP BY 1 HAVING count(*) = 3"),
    "get_skeleton_ids": _sql("SELECT DISTINCT skeleton_id FROM tn WHERE creator_id = 3 AND created >= '2020-01-05' AND created < '2020-03-01' AND node_id IN (SELECT node_id FROM rv WHERE reviewer_id = 4)"),
    "get_skeleton_ids_by_size": _sql("SELECT skeleton_id FROM tn GROUP BY 1 HAVING count(*) > 75"),
    "has_soma": _sql(f"SELECT skeleton_id, coalesce(s, '') AS somas FROM sk LEFT JOIN (SELECT skeleton_id, {_list('node_id')} AS s FROM tn WHERE radius >= 45 AND node_id % 5 = 0 GROUP BY 1) USING (skeleton_id)"),
    "get_user_list": _sql("SELECT user_id, login, coalesce(nullif(full_name, ''), trim(first_name || ' ' || coalesce(last_name, ''))) AS full_name, first_name, coalesce(last_name, '') AS last_name FROM us"),
    "get_transactions": _sql("SELECT event_id AS transaction_id, login, event_type AS label, ts AS executed FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 40 OFFSET 10) e LEFT JOIN us ON us.user_id = e.user_id % 30"),
    "get_sampler": "SELECT o_orderkey AS sampler_id, o_custkey AS skeleton_id, o_orderkey * 60 AS created FROM orders WHERE o_custkey IN (SELECT s_suppkey FROM supplier)",
    "get_sampler_domains": "SELECT l_orderkey % 100 AS sampler_id, l_partkey AS start_node_id FROM lineitem WHERE l_orderkey % 100 = 7",
    "get_sampler_counts": "SELECT skeleton_id, coalesce(n, 0) AS n FROM (SELECT DISTINCT c_custkey % 50 AS skeleton_id FROM customer) LEFT JOIN (SELECT o_custkey % 40 AS skeleton_id, count(*) AS n FROM orders GROUP BY 1) USING (skeleton_id)",
    "get_neuron": _sql("SELECT skeleton_id, name, n_nodes, coalesce(n_connectors, 0) AS n_connectors, coalesce(n_tags, 0) AS n_tags, n_roots, c AS connectors, nodes FROM sk JOIN (SELECT skeleton_id, count(*) AS n_nodes, count(*) FILTER (parent_id IS NULL) AS n_roots, CAST(sum(node_id * confidence) AS BIGINT) AS nodes FROM tn GROUP BY 1) USING (skeleton_id) LEFT JOIN (SELECT skeleton_id, count(*) AS n_connectors, CAST(sum(connector_id * CASE relation WHEN 'presynaptic_to' THEN 1 ELSE 2 END) AS BIGINT) AS c FROM ln GROUP BY 1) USING (skeleton_id) LEFT JOIN (SELECT skeleton_id, count(*) AS n_tags FROM tg JOIN tn USING (node_id) WHERE kind = 'node' GROUP BY 1) USING (skeleton_id)"),
    "missing_neurons": _sql("SELECT s_suppkey AS skeleton_id FROM supplier WHERE s_suppkey NOT IN (SELECT skeleton_id FROM sk)"),
    "get_arbor": _sql("SELECT a.skeleton_id, a.relation, b.relation AS other_relation, count(*) AS n, CAST(sum(b.node_id) AS BIGINT) AS others FROM ln a JOIN ln b ON a.connector_id = b.connector_id AND a.node_id <> b.node_id WHERE a.skeleton_id IN (SELECT s_suppkey FROM supplier) GROUP BY 1, 2, 3"),
    "get_history": _sql(f"SELECT user_id, day, {_SUMS} FROM ({_DAYS}) GROUP BY 1, 2"),
    "get_user_stats": _sql(f"SELECT user_id, {_SUMS} FROM ({_DAYS}) GROUP BY 1"),
    "get_user_actions": _sql("""SELECT login AS "user", action, count(*) AS n, min(t) AS first, max(t) AS last FROM (SELECT creator_id AS u, created AS t, 'creation' AS action FROM tn WHERE skeleton_id % 2 = 0 UNION ALL SELECT editor_id, edited, 'edition' FROM tn WHERE skeleton_id % 2 = 0 AND edited > created + INTERVAL 200 MILLISECOND UNION ALL SELECT reviewer_id, reviewed, 'review' FROM rv WHERE node_id IN (SELECT node_id FROM tn WHERE skeleton_id % 2 = 0) UNION ALL SELECT creator_id, created, 'linking' FROM ln WHERE skeleton_id IN (SELECT skeleton_id FROM tn WHERE skeleton_id % 2 = 0)) JOIN us ON user_id = u WHERE u % 3 = 1 GROUP BY 1, 2"""),
    "get_review_details": _sql("SELECT node_id, skeleton_id, max(reviewed) FILTER (reviewer_id = 1) AS u1, max(reviewed) FILTER (reviewer_id = 2) AS u2, max(reviewed) FILTER (reviewer_id = 3) AS u3 FROM rv JOIN tn USING (node_id) WHERE reviewer_id IN (1, 2, 3) GROUP BY 1, 2"),
    "get_connectors": _sql("SELECT connector_id, x, y, z, created AS creation_time, login AS creator, type FROM cn JOIN us ON user_id = creator_id JOIN (SELECT connector_id, arg_min(relation, (node_id, skeleton_id, relation)) AS type FROM ln GROUP BY 1) USING (connector_id) WHERE connector_id IN (SELECT l_orderkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey < 5) AND connector_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')"),
    "get_connectors_in_bbox": _sql("SELECT connector_id, x, y, z FROM cn WHERE x BETWEEN 40000 AND 400000 AND y BETWEEN 0 AND 800 AND z BETWEEN 0 AND 960"),
    "get_connectors_in_bbox_links": _sql("SELECT relation, count(*) AS n, CAST(sum(node_id) AS BIGINT) AS nodes FROM ln WHERE connector_id IN (SELECT connector_id FROM cn WHERE x BETWEEN 40000 AND 300000 AND y BETWEEN 0 AND 500 AND z BETWEEN 0 AND 900) GROUP BY 1"),
    "get_connector_details": _sql(f"SELECT connector_id, min(skeleton_id) FILTER (relation = 'presynaptic_to') AS presynaptic_to, {_list('q')} AS postsynaptic_to, min(node_id) FILTER (relation = 'presynaptic_to') AS presynaptic_to_node, {_list('m', distinct=False)} AS postsynaptic_to_node FROM (SELECT *, CASE WHEN relation = 'postsynaptic_to' THEN skeleton_id END AS q, CASE WHEN relation = 'postsynaptic_to' THEN node_id END AS m FROM ln) GROUP BY 1"),
    "get_connectors_between": _sql("SELECT p.connector_id, p.skeleton_id AS source_neuron, q.skeleton_id AS target_neuron, p.node_id AS node1_id, q.node_id AS node2_id, q.confidence AS confidence2, cn.x AS cx, tn.y AS y2 FROM ln p JOIN ln q ON p.connector_id = q.connector_id AND p.relation = 'presynaptic_to' AND q.relation = 'postsynaptic_to' JOIN customer a ON a.c_custkey = p.skeleton_id JOIN customer b ON b.c_custkey = q.skeleton_id JOIN cn ON cn.connector_id = p.connector_id LEFT JOIN tn ON tn.node_id = q.node_id WHERE (a.c_nationkey = 5 AND b.c_nationkey < 5) OR (a.c_nationkey < 5 AND b.c_nationkey = 5)"),
    "get_connector_links_tags": _sql("SELECT coalesce(tag, '') AS tags, relation, count(*) AS n FROM ln LEFT JOIN (SELECT node_id AS connector_id, tag FROM tg WHERE kind = 'connector') USING (connector_id) WHERE skeleton_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5) GROUP BY 1, 2"),
    "adjacency_from_connectors": _sql(f"SELECT source, target, count(*) AS weight FROM {_EDGES.format('fragment_id', 'fr', '', '')} GROUP BY 1, 2"),
    "edges_from_connectors": _sql(f"SELECT source, target, count(*) AS weight FROM {_EDGES.format('skeleton_id', 'ln', ' AND skeleton_id IN (SELECT c_custkey FROM customer WHERE c_nationkey < 9)', ' AND skeleton_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)')} GROUP BY 1, 2"),
    "cn_table_from_connectors": _sql("""SELECT relation, partner, query, count(*) AS weight, CAST(sum(count(*)) OVER (PARTITION BY relation, partner) AS BIGINT) AS total FROM (SELECT 'downstream' AS relation, b.fragment_id AS partner, a.fragment_id AS query FROM fr a JOIN fr b USING (connector_id) WHERE a.relation = 'presynaptic_to' AND b.relation = 'postsynaptic_to' AND a.fragment_id IN (SELECT fragment_id FROM fr WHERE skeleton_id % 20 = 3) UNION ALL
SELECT 'upstream', a.fragment_id, b.fragment_id FROM fr a JOIN fr b USING (connector_id) WHERE a.relation = 'presynaptic_to' AND b.relation = 'postsynaptic_to' AND b.fragment_id IN (SELECT fragment_id FROM fr WHERE skeleton_id % 20 = 3) AND connector_id NOT IN (SELECT connector_id FROM fr WHERE relation = 'presynaptic_to' AND fragment_id IN (SELECT fragment_id FROM fr WHERE skeleton_id % 20 = 3))) GROUP BY 1, 2, 3"""),
    "get_partners_in_volume": _sql(f"""SELECT relation, partner, query, weight, total FROM (SELECT *, CAST(sum(weight) OVER (PARTITION BY relation, partner) AS BIGINT) AS total FROM (SELECT 'downstream' AS relation, target AS partner, source AS query, count(*) AS weight FROM (SELECT * FROM {_EDGES.format('skeleton_id', 'ln', '', '')}) WHERE source IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AND connector_id IN (SELECT connector_id FROM cn WHERE x <= 200000 AND z <= 500) GROUP BY 1, 2, 3
UNION ALL SELECT 'upstream', source, target, count(*) FROM (SELECT * FROM {_EDGES.format('skeleton_id', 'ln', '', '')}) WHERE target IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AND connector_id IN (SELECT connector_id FROM cn WHERE x <= 200000 AND z <= 500) GROUP BY 1, 2, 3)) WHERE total >= 2 AND partner IN (SELECT skeleton_id FROM ln GROUP BY 1 HAVING count(*) >= 12)"""),
    "get_annotation_table": _sql(f"SELECT annotation_id, name, users, times_used, last_used FROM nt LEFT JOIN (SELECT annotation_id, {_list('user_id')} AS users, count(*) AS times_used, max(marked) AS last_used FROM mk GROUP BY 1) USING (annotation_id)"),
    "get_annotation_id": _sql("SELECT term, annotation_id, name FROM nt, (SELECT unnest(['/[a-e].*', 'meta 2', '~click']) AS term) WHERE (term = '/[a-e].*' AND regexp_matches(name, '^[a-e]')) OR (term = 'meta 2' AND name = 'meta 2') OR (term = '~click' AND name = 'click')"),
    "get_annotation_details": _sql("""SELECT name AS annotation, login AS "user", count(*) AS n, date_trunc('minute', min(marked)) AS first, date_trunc('minute', max(marked)) AS last FROM mk JOIN nt USING (annotation_id) LEFT JOIN us USING (user_id) GROUP BY 1, 2"""),
    "get_user_annotations": _sql("SELECT user_id, annotation_id, name AS annotation, count(*) AS times_used, max(marked) AS last_used FROM mk JOIN nt USING (annotation_id) WHERE user_id < 12 GROUP BY ALL"),
    "get_entities": _sql("SELECT entity_id, kind, name FROM en WHERE kind = 'neuron' AND entity_id IN (SELECT entity_id FROM mk JOIN nt USING (annotation_id) WHERE user_id = 7 AND nt.name IN ('click', 'purchase')) AND entity_id IN (SELECT entity_id FROM mk JOIN nt USING (annotation_id) WHERE user_id = 7 AND nt.name IN ('view', 'error')) AND entity_id NOT IN (SELECT entity_id FROM mk JOIN nt USING (annotation_id) WHERE user_id = 7 AND nt.name = 'signup')"),
    "get_entities_expanded": _sql("SELECT entity_id, kind, name FROM en WHERE entity_id > 3 OR (entity_id IN (SELECT annotation_id FROM meta) AND entity_id < 3)"),
    "get_entity_graph": _sql("SELECT source, target, kind FROM (SELECT DISTINCT annotation_id, entity_id, nt.name AS source, en.name AS target, en.kind FROM mk JOIN nt USING (annotation_id) JOIN en USING (entity_id))"),
    "ambiguous_names": _sql("SELECT name, count(*) AS n FROM en GROUP BY 1 HAVING count(*) > 1"),
    "get_annotation_graph": _sql("SELECT DISTINCT annotation_id AS source, CASE WHEN kind = 'neuron' THEN entity_id * 10 ELSE entity_id END AS target, CASE WHEN kind = 'neuron' THEN 'skeleton' ELSE kind END AS kind FROM mk JOIN en USING (entity_id) WHERE annotation_id IN (SELECT annotation_id FROM nt) AND (kind <> 'neuron' OR entity_id % 2 = 0)"),
    "annotations_by_annotation": _sql("SELECT DISTINCT annotation_id FROM meta UNION SELECT entity_id FROM meta"),
    "annotations_by_user": _sql("SELECT DISTINCT annotation_id FROM mk WHERE user_id = 0"),
}
