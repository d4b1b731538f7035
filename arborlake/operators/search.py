"""Search by name, annotation and combined criteria.

Entities carry annotations as rows (entity_id, annotation); ``~`` before a term negates it.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .trees import cut


def name_matches(name: Column, query: str, allow_partial: bool = False) -> Column:
    """A predicate on names. The query is trimmed; one prefix ``annotation:`` and then one ``~`` are ignored. A leading ``/`` makes
    the rest a regular expression anchored at the start; otherwise the query is literal, and whole unless partial matches are allowed."""
    query = query.strip()
    for prefix in ("annotation:", "~"):
        query = query.removeprefix(prefix)
    if query.startswith("/"):
        return name.rlike(f"^(?:{query[1:]})")
    return F.contains(name, F.lit(query)) if allow_partial else name == F.lit(query)


def filter_by_query(df: DataFrame, column: str, query: str, allow_partial: bool = False) -> DataFrame:
    return df.where(name_matches(F.col(column), query, allow_partial))


def split_conditions(terms: list[str]) -> tuple[list[str], list[str]]:
    """Wanted terms and negated ones, these without their ``~``."""
    return [t for t in terms if not t.startswith("~")], [t[1:] for t in terms if t.startswith("~")]


def ids_by_annotation(annotations: DataFrame, universe: DataFrame, terms: list[str], intersect: bool = False, allow_partial: bool = False) -> DataFrame:
    """(entity_id) by annotations. Intersecting: has all wanted, none of the negated. Otherwise each term counts by itself:
    those that carry any wanted term, and those that lack any negated one. ``universe``: all entities (entity_id)."""
    wanted, negated = split_conditions(terms)
    match = lambda t: name_matches(F.col("annotation"), t, allow_partial)
    flags = [F.max(match(t).cast("int")).alias(f"f{i}") for i, t in enumerate([*wanted, *negated])]
    has = universe.select("entity_id").distinct().join(annotations.groupBy("entity_id").agg(*flags), "entity_id", "left").na.fill(0)
    checks = [F.col(f"f{i}") == (1 if i < len(wanted) else 0) for i in range(len(flags))]
    return has.where(reduce(Column.__and__ if intersect else Column.__or__, checks)).select("entity_id")


def has_annotation(annotations: DataFrame, neurons: DataFrame, terms: list[str], intersect: bool = False, partial: bool = False) -> DataFrame:
    """Filter of a neuron list. Wanted: any of them, or all when intersecting. Excluded: those with any negated term, or with all of them when intersecting."""
    wanted, negated = split_conditions(terms)
    match = lambda t: F.max(name_matches(F.col("annotation"), t, partial).cast("int"))
    flags = [match(t).alias(f"f{i}") for i, t in enumerate([*wanted, *negated])]
    found = neurons.join(annotations.groupBy("entity_id").agg(*flags), "entity_id", "left").na.fill(0, [f"f{i}" for i in range(len(flags))])
    how = Column.__and__ if intersect else Column.__or__
    ok = F.lit(True)
    if wanted:
        ok = reduce(how, [F.col(f"f{i}") == 1 for i in range(len(wanted))])
    if negated:
        ok = ok & ~reduce(how, [F.col(f"f{len(wanted) + i}") == 1 for i in range(len(negated))])
    return found.where(ok).select(*neurons.columns)


def annotation_counts(annotations: DataFrame) -> DataFrame:
    return annotations.groupBy("annotation").agg(F.count_distinct("entity_id").alias("entities"))


def annotations_of(annotations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(entity_id, annotations): a sorted list for each entity."""
    own = annotations if ids is None else annotations.join(ids.select("entity_id").distinct(), "entity_id", "left_semi")
    return own.groupBy("entity_id").agg(F.array_sort(F.collect_set("annotation")).alias("annotations"))


def entity_graph(annotations: DataFrame, entities: DataFrame) -> DataFrame:
    """(source, target): edges from annotation to entity, of entities that are known."""
    return annotations.join(entities.select("entity_id").distinct(), "entity_id", "left_semi").select(F.col("annotation").alias("source"), F.col("entity_id").alias("target")).distinct()


def sub_annotations(meta: DataFrame, start: DataFrame, depth: int | None = None) -> DataFrame:
    """(annotation, level): the closure under meta-annotation edges (parent, child), by first level; ``start`` has level 0. Ends where no new annotation follows, or at ``depth``."""
    front = seen = start.select("annotation").distinct().withColumn("level", F.lit(0))
    edges = meta.select(F.col("parent").alias("annotation"), "child")
    level = 0
    while depth is None or level < depth:
        level += 1
        front = cut(front.join(edges, "annotation").select(F.col("child").alias("annotation")).distinct().join(seen.select("annotation"), "annotation", "left_anti").withColumn("level", F.lit(level)))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
        if level % 3 == 0:
            seen = cut(seen)
    return seen


def combine(sets: list[DataFrame], intersect: bool = False) -> DataFrame:
    """Union or intersection of tables of entity ids, in one aggregation."""
    rows = reduce(DataFrame.unionByName, [s.select("entity_id").distinct().withColumn("part", F.lit(i)) for i, s in enumerate(sets)])
    out = rows.groupBy("entity_id").agg(F.count("*").alias("n"))
    return (out.where(F.col("n") == len(sets)) if intersect else out).select("entity_id")


def find_neurons(sets: list[DataFrame], facts: DataFrame, intersect: bool = False, only_soma: bool = False, min_size: int = 1, min_cable: float | None = None) -> DataFrame:
    """Criteria as tables of ids, joined by union or intersection; then size, soma and cable filters on ``facts`` (entity_id, num_nodes, has_soma, cable)."""
    ok = F.col("num_nodes") >= min_size
    if only_soma:
        ok = ok & F.col("has_soma")
    if min_cable is not None:
        ok = ok & (F.col("cable") >= min_cable)
    return combine(sets, intersect).join(facts.where(ok).select("entity_id"), "entity_id", "left_semi")


def resolve_ids(terms: list[str | int], names: DataFrame, annotations: DataFrame) -> DataFrame:
    """(entity_id, pos): ids from numbers, ``name:`` or bare names and ``annotation:`` terms, each once, in order of first mention."""
    spark = names.sparkSession
    found = [spark.createDataFrame([], "entity_id long, pos int")]
    for pos, t in enumerate(terms):
        if isinstance(t, int) or re.fullmatch(r"\d+", t):
            part = spark.range(1).select(F.lit(int(t)).cast("long").alias("entity_id"))
        elif t.startswith(("annotation:", "annotations:")):
            part = annotations.where(name_matches(F.col("annotation"), t.split(":", 1)[1]))
        else:
            part = names.where(name_matches(F.col("name"), t.removeprefix("name:")))
        found.append(part.select("entity_id", F.lit(pos).alias("pos")))
    return reduce(DataFrame.unionByName, found).groupBy("entity_id").agg(F.min("pos").alias("pos"))


def resolve_users(terms: list[str], users: DataFrame) -> DataFrame:
    """(term, user_id): the first of login, last, full and first name that fits; terms that fit several users are left out."""
    spark = users.sparkSession
    wanted = spark.createDataFrame([(t,) for t in terms], "term string")
    order = ("login", "last_name", "full_name", "first_name")
    tried = reduce(DataFrame.unionByName, [users.select(F.col(c).alias("term"), "user_id", F.lit(i).alias("rank")) for i, c in enumerate(order)])
    hits = wanted.join(tried, "term").groupBy("term", "rank").agg(F.collect_set("user_id").alias("ids"))
    best = hits.groupBy("term").agg(F.min_by("ids", "rank").alias("ids"))
    return best.where(F.size("ids") == 1).select("term", F.col("ids")[0].alias("user_id"))
