"""Search and annotation queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import search as s
from ..sources import lake

ANN = "ann AS (SELECT DISTINCT p_partkey AS entity_id, unnest(list_concat(string_split(p_name, ' '), [p_brand, p_type])) AS annotation FROM part)"


def _part(spark, d):
    return lake.table(spark, d, "part").select(F.col("p_partkey").alias("entity_id"), F.col("p_name").alias("name"), "p_size")


def _by_name(query, partial):
    return lambda spark, d: s.filter_by_query(_part(spark, d), "name", query, partial).select("entity_id", "name")


def _by_annotation(terms, intersect):
    return lambda spark, d: s.ids_by_annotation(lake.annotations(spark, d), _part(spark, d), terms, intersect)


def has_annotation(spark, d):
    return s.has_annotation(lake.annotations(spark, d), _part(spark, d).select("entity_id"), ["Brand#1", "~Brand#12"], partial=True)


def annotations_of(spark, d):
    return s.annotations_of(lake.annotations(spark, d)).select("entity_id", F.array_join("annotations", "|").alias("annotations"))


def annotation_counts(spark, d):
    return s.annotation_counts(lake.annotations(spark, d))


def entity_graph(spark, d):
    return s.entity_graph(lake.annotations(spark, d), _part(spark, d).where("p_size < 10"))


def sub_annotations(spark, d):
    """Closure over nodes of the part tree as if they were annotations."""
    tree = lake.nodes(spark, d).where("parent_id IS NOT NULL").select(F.col("parent_id").cast("string").alias("parent"), F.col("node_id").cast("string").alias("child"))
    start = spark.range(1).select(F.lit("5").alias("annotation"))
    return s.sub_annotations(tree, start, 2)


def sub_annotations_all(spark, d):
    """The whole closure, from all roots."""
    tree = lake.nodes(spark, d).where("parent_id IS NOT NULL").select(F.col("parent_id").cast("string").alias("parent"), F.col("node_id").cast("string").alias("child"))
    roots = tree.select(F.col("parent").alias("annotation")).join(tree.select(F.col("child").alias("annotation")), "annotation", "left_anti").distinct()
    return s.sub_annotations(tree, roots)


def find_neurons(spark, d):
    part, ann = _part(spark, d), lake.annotations(spark, d)
    sets = [s.filter_by_query(part, "name", "/[a-m].*"), ann.where("annotation LIKE 'Brand#1%'")]
    facts = part.select("entity_id", F.col("p_size").alias("num_nodes"), F.lit(True).alias("has_soma"), F.lit(0.0).alias("cable"))
    return s.find_neurons(sets, facts, intersect=True, min_size=20)


def resolve(spark, d):
    part = _part(spark, d)
    return s.resolve_ids([7, "3", "annotation:/Brand#1.*", "name:/a.*"], part, lake.annotations(spark, d))


QUERIES = {
    "filter_by_query_regex": _by_name("/[a-m].*", False), "filter_by_query_partial": _by_name("annotation:an", True), "skids_by_annotation_union": _by_annotation(["/Brand#1.*", "~/Brand#[12].*"], False),
    "skids_by_annotation_intersect": _by_annotation(["/Brand#1.*", "~/Brand#12"], True), "has_annotation": has_annotation, "get_annotations": annotations_of,
    "annotation_counts": annotation_counts, "entity_graph": entity_graph, "sub_annotations": sub_annotations, "sub_annotations_all": sub_annotations_all, "find_neurons": find_neurons, "eval_skids": resolve,
}

SQL = {
    "filter_by_query_regex": "SELECT p_partkey AS entity_id, p_name AS name FROM part WHERE regexp_matches(p_name, '^(?:[a-m].*)')",
    "filter_by_query_partial": "SELECT p_partkey AS entity_id, p_name AS name FROM part WHERE contains(p_name, 'an')",
    "skids_by_annotation_union": f"WITH {ANN} SELECT p_partkey AS entity_id FROM part WHERE p_partkey IN (SELECT entity_id FROM ann WHERE regexp_matches(annotation, '^(?:Brand#1.*)')) OR p_partkey NOT IN (SELECT entity_id FROM ann WHERE regexp_matches(annotation, '^(?:Brand#[12].*)'))",
    "skids_by_annotation_intersect": f"WITH {ANN} SELECT p_partkey AS entity_id FROM part WHERE p_partkey IN (SELECT entity_id FROM ann WHERE regexp_matches(annotation, '^(?:Brand#1.*)')) AND p_partkey NOT IN (SELECT entity_id FROM ann WHERE regexp_matches(annotation, '^(?:Brand#12)'))",
    "has_annotation": f"WITH {ANN} SELECT p_partkey AS entity_id FROM part WHERE p_partkey IN (SELECT entity_id FROM ann WHERE contains(annotation, 'Brand#1')) AND p_partkey NOT IN (SELECT entity_id FROM ann WHERE contains(annotation, 'Brand#12'))",
    "get_annotations": f"WITH {ANN} SELECT entity_id, string_agg(annotation, '|' ORDER BY annotation) AS annotations FROM ann GROUP BY 1",
    "annotation_counts": f"WITH {ANN} SELECT annotation, count(DISTINCT entity_id) AS entities FROM ann GROUP BY 1",
    "entity_graph": f"WITH {ANN} SELECT DISTINCT annotation AS source, entity_id AS target FROM ann JOIN part ON p_partkey = entity_id WHERE p_size < 10",
    "sub_annotations": "SELECT CAST(p_partkey AS VARCHAR) AS annotation, CASE WHEN p_partkey = 5 THEN 0 WHEN p_partkey // 2 = 5 THEN 1 ELSE 2 END AS level FROM part WHERE p_partkey = 5 OR p_partkey // 2 = 5 OR p_partkey // 4 = 5",
    "sub_annotations_all": "WITH RECURSIVE r AS (SELECT 0::BIGINT AS id, 0 AS level UNION ALL SELECT p_partkey, level + 1 FROM part JOIN r ON p_partkey // 2 = id WHERE p_partkey > 0) SELECT CAST(id AS VARCHAR) AS annotation, level FROM r",
    "find_neurons": "SELECT p_partkey AS entity_id FROM part WHERE regexp_matches(p_name, '^(?:[a-m].*)') AND p_brand LIKE 'Brand#1%' AND p_size >= 20",
    "eval_skids": f"WITH {ANN}, t AS (SELECT 7 AS entity_id, 0 AS pos UNION ALL SELECT 3, 1 UNION ALL SELECT entity_id, 2 FROM ann WHERE regexp_matches(annotation, '^(?:Brand#1.*)') UNION ALL SELECT p_partkey, 3 FROM part WHERE regexp_matches(p_name, '^(?:a.*)')) SELECT CAST(entity_id AS BIGINT) AS entity_id, CAST(min(pos) AS INT) AS pos FROM t GROUP BY 1",
}
