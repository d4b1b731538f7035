"""Annotations as a graph over typed entities.

notes: annotation_id, name. marks: annotation_id, entity_id, user_id, marked (a row an annotation of an entity).
entities: entity_id, kind (neuron, annotation, volume or skeleton), name. Neurons stand in their skeletons (neuron_id, skeleton_id).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .search import name_matches, sub_annotations

KINDS = ("neuron", "annotation", "volume", "skeleton")


def annotation_table(notes: DataFrame, marks: DataFrame) -> DataFrame:
    """Annotations with their users and how often and when they were last used."""
    used = marks.groupBy("annotation_id").agg(F.array_sort(F.collect_set("user_id")).alias("users"), F.count("*").alias("times_used"), F.max("marked").alias("last_used"))
    return notes.join(used, "annotation_id", "left")


def annotation_ids(notes: DataFrame, terms: list[str], partial: bool = False) -> DataFrame:
    """(term, annotation_id, name) of all annotations that a term fits."""
    fits = F.array_compact(F.array(*[F.when(name_matches(F.col("name"), t, partial), F.lit(t)) for t in terms]))
    return notes.select(F.explode(fits).alias("term"), "annotation_id", "name")


def nested_ids(notes: DataFrame, terms: list[list[str]]) -> DataFrame:
    """(clause, annotation_id): the terms of each clause resolved; clauses are joined by AND, their terms by OR."""
    each = [annotation_ids(notes, clause).select(F.lit(i).alias("clause"), "annotation_id") for i, clause in enumerate(terms)]
    return reduce(DataFrame.unionByName, each).distinct()


def annotation_details(marks: DataFrame, notes: DataFrame, users: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """A row an entity and annotation with user and minute, by annotation."""
    own = marks if entities is None else marks.join(entities.select("entity_id").distinct(), "entity_id", "left_semi")
    minute = F.expr("timestampadd(SECOND, -CAST(extract(SECOND FROM marked) AS INT), CAST(date_format(marked, 'yyyy-MM-dd HH:mm:ss') AS TIMESTAMP_NTZ))")
    out = own.join(notes, "annotation_id").join(users.select("user_id", F.col("login").alias("user")), "user_id", "left")
    return out.select(F.col("name").alias("annotation"), "entity_id", minute.alias("time_annotated"), "user_id", "annotation_id", "user").orderBy("annotation", "entity_id")


def user_annotations(marks: DataFrame, notes: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """(user_id, annotation_id, annotation, times_used, last_used), most used first."""
    own = marks if users is None else marks.join(users.select("user_id").distinct(), "user_id", "left_semi")
    per = own.groupBy("user_id", "annotation_id").agg(F.count("*").alias("times_used"), F.max("marked").alias("last_used"))
    return per.join(notes.select("annotation_id", F.col("name").alias("annotation")), "annotation_id").orderBy(F.desc("times_used"), "user_id", "annotation_id")


def select_entities(marks: DataFrame, entities: DataFrame, annotated: DataFrame | None = None, not_annotated: DataFrame | None = None, kinds: tuple[str, ...] | None = None, below: DataFrame | None = None) -> DataFrame:
    """Entities of some kinds that carry an annotation of every clause of ``annotated`` and of no whole clause of ``not_annotated`` (clause, annotation_id).

    ``below`` (annotation_id) lists annotations whose sub-annotations count as themselves.
    """
    if kinds is not None and (unknown := set(kinds) - set(KINDS)):
        raise ValueError(f"unknown kinds {sorted(unknown)}")
    out = entities if kinds is None else entities.where(F.col("kind").isin(*kinds))
    own = marks.select("entity_id", "annotation_id").distinct()
    if below is not None:
        own = own.unionByName(_through(own, entities, below)).distinct()

    def clauses(wanted: DataFrame) -> DataFrame:
        """Entities that meet all clauses."""
        n = wanted.select("clause").distinct().count()
        met = own.join(wanted, "annotation_id").select("entity_id", "clause").distinct().groupBy("entity_id").agg(F.count("*").alias("n"))
        return met.where(F.col("n") == n).select("entity_id")

    if annotated is not None:
        out = out.join(clauses(annotated), "entity_id", "left_semi")
    if not_annotated is not None:
        out = out.join(own.join(not_annotated, "annotation_id").select("entity_id").distinct(), "entity_id", "left_anti")
    return out


def _through(own: DataFrame, entities: DataFrame, below: DataFrame) -> DataFrame:
    """(entity_id, annotation_id) of entities that carry a sub-annotation of an annotation in ``below``."""
    notes = entities.where("kind = 'annotation'").select(F.col("entity_id").alias("child"))
    meta = own.join(notes, F.col("entity_id") == F.col("child")).select(F.col("annotation_id").alias("parent"), "child")
    found = None
    for row in below.select("annotation_id").distinct().toLocalIterator():  # the few that a user lists
        start = below.where(F.col("annotation_id") == row[0]).select(F.col("annotation_id").alias("annotation")).distinct()
        part = sub_annotations(meta, start).where("level > 0").select(F.col("annotation").alias("annotation_id")).join(own, "annotation_id").select("entity_id", F.lit(row[0]).alias("annotation_id"))
        found = part if found is None else found.unionByName(part)
    return found if found is not None else own.limit(0)


def entity_edges(marks: DataFrame, entities: DataFrame, by_name: bool = False) -> DataFrame:
    """(source, target, kind): edges from annotations to what they mark; those from or to unknown entities are dropped."""
    node = entities.select("entity_id", "kind", "name")
    out = marks.select("annotation_id", "entity_id").distinct().join(node.where("kind = 'annotation'").select(F.col("entity_id").alias("annotation_id"), F.col("name").alias("source_name")), "annotation_id").join(node, "entity_id")
    return out.select(*((F.col("source_name").alias("source"), F.col("name").alias("target")) if by_name else (F.col("annotation_id").alias("source"), F.col("entity_id").alias("target"))), "kind")


def ambiguous_names(entities: DataFrame) -> DataFrame:
    """(name, n) of names that several entities bear, which a graph by name can't tell apart."""
    return entities.groupBy("name").agg(F.count("*").alias("n")).where("n > 1")


def to_skeletons(edges: DataFrame, skeletons: DataFrame, single: bool = False) -> DataFrame:
    """Edges with neurons replaced by their skeletons; with ``single`` only neurons of one skeleton stay."""
    own = skeletons.select(F.col("neuron_id").alias("target"), "skeleton_id")
    if single:
        one = own.groupBy("target").agg(F.count("*").alias("n")).where("n = 1").select("target")
        own = own.join(one, "target", "left_semi")
    turned = edges.where("kind = 'neuron'").join(own, "target").select("source", F.col("skeleton_id").alias("target"), F.lit("skeleton").alias("kind"))
    return edges.where("kind <> 'neuron'").unionByName(turned)


def annotations_under(marks: DataFrame, entities: DataFrame, annotation_id: int, closure: bool = False) -> DataFrame:
    """(annotation_id) directly under a meta-annotation, or all the way down."""
    notes = entities.where("kind = 'annotation'").select(F.col("entity_id").alias("child"))
    meta = marks.join(notes, F.col("entity_id") == F.col("child")).select(F.col("annotation_id").alias("parent"), "child").distinct()
    if not closure:
        return meta.where(F.col("parent") == annotation_id).select(F.col("child").alias("annotation_id"))
    start = meta.where(F.col("parent") == annotation_id).select(F.col("parent").alias("annotation")).distinct()
    return sub_annotations(meta, start).where("level > 0").select(F.col("annotation").alias("annotation_id"))


def annotations_by_user(marks: DataFrame, user: int) -> DataFrame:
    return marks.where(F.col("user_id") == user).select("annotation_id").distinct()


def flatten(nested: Column) -> Column:
    """A list of lists as one list."""
    return F.flatten(nested)


def map_nested(nested: Column, mapping: Column) -> Column:
    """A list of lists with each item looked up in a map."""
    return F.transform(nested, lambda part: F.transform(part, lambda x: F.try_element_at(mapping, x)))
