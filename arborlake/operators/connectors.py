"""Readers of connectors, and connectivity that tells the fragments of one skeleton apart.

links: connector_id, node_id, skeleton_id, relation, confidence, and optionally fragment_id, creator_id, created.
A weight counts links, not distinct neurons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .connectivity import dealt
from .readers import _only, box_in_nm, inside

PRE, POST = "presynaptic_to", "postsynaptic_to"


def connectors_of(connectors: DataFrame, links: DataFrame, users: DataFrame, skeletons: DataFrame | None = None, relation: str | None = None, tags: DataFrame | None = None) -> DataFrame:
    """Connectors with links to ``skeletons``, of one relation, with any of ``tags`` (connector_id); their type is the relation of the first link by node and skeleton."""
    kind = links.groupBy("connector_id").agg(F.min_by("relation", F.struct("node_id", "skeleton_id", "relation")).alias("type"))
    wanted = links if relation is None else links.where(F.col("relation") == relation)
    wanted = _only(wanted, skeletons, "skeleton_id")
    out = connectors if skeletons is None and relation is None else _only(connectors, wanted, "connector_id")
    out = _only(out, tags, "connector_id").join(kind, "connector_id", "left")
    return out.join(users.select(F.col("user_id").alias("creator_id"), F.col("login").alias("creator")), "creator_id", "left").select("connector_id", "x", "y", "z", F.col("created").alias("creation_time"), "creator", "type")


def connectors_in_box(connectors: DataFrame, links: DataFrame, box: tuple[tuple, tuple], unit: str = "NM", give: str = "COORDS", limit: int | None = None) -> DataFrame:
    """Connectors in a box as ids, coordinates or links; ``limit`` takes the first by id, if asked for."""
    found = connectors.where(inside(box_in_nm(box, unit)))
    if limit is not None:
        found = found.orderBy("connector_id").limit(limit)
    if give == "IDS":
        return found.select("connector_id")
    if give == "COORDS":
        return found.select("connector_id", "x", "y", "z")
    if give == "LINKS":
        return links.join(found.select("connector_id"), "connector_id", "left_semi")
    raise ValueError("give is IDS, COORDS or LINKS")


def connector_nodes(links: DataFrame) -> DataFrame:
    """Per connector: its presynaptic neuron and node, the distinct postsynaptic neurons, and all postsynaptic nodes."""
    pre, post = F.col("relation") == PRE, F.col("relation") == POST
    first = lambda c: F.min(F.when(pre, F.struct("skeleton_id", "node_id")))[c]
    return links.groupBy("connector_id").agg(
        first("skeleton_id").alias("presynaptic_to"),
        F.array_sort(F.collect_set(F.when(post, F.col("skeleton_id")))).alias("postsynaptic_to"),
        first("node_id").alias("presynaptic_to_node"),
        F.array_sort(F.collect_list(F.when(post, F.col("node_id")))).alias("postsynaptic_to_node"),
    )


def links_between(connectors: DataFrame, links: DataFrame, nodes: DataFrame, a: DataFrame, b: DataFrame, directional: bool = True) -> DataFrame:
    """Pairs of links from the skeletons ``a`` onto ``b`` (skeleton_id) with the places of connector and nodes; also the other way round if not ``directional``."""
    place = connectors.select("connector_id", F.struct("x", "y", "z").alias("connector_loc"))
    at = lambda k: nodes.select(F.col("node_id").alias(f"node{k}_id"), F.struct("x", "y", "z").alias(f"node{k}_loc"))

    def one_way(x: DataFrame, y: DataFrame) -> DataFrame:
        pre = _only(links.where(F.col("relation") == PRE), x, "skeleton_id").select("connector_id", F.col("node_id").alias("node1_id"), F.col("skeleton_id").alias("source_neuron"), F.col("confidence").alias("confidence1"))
        post = _only(links.where(F.col("relation") == POST), y, "skeleton_id").select("connector_id", F.col("node_id").alias("node2_id"), F.col("skeleton_id").alias("target_neuron"), F.col("confidence").alias("confidence2"))
        return pre.join(post, "connector_id")

    out = one_way(a, b)
    out = out if directional else out.unionByName(one_way(b, a))
    return out.join(place, "connector_id", "left").join(at(1), "node1_id", "left").join(at(2), "node2_id", "left")


def link_tags(links: DataFrame, tags: DataFrame, skeletons: DataFrame | None = None) -> DataFrame:
    """Links of skeletons with the tags of their connectors (node_id, tag, kind)."""
    own = tags.where("kind = 'connector'").groupBy(F.col("node_id").alias("connector_id")).agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    return _only(links, skeletons, "skeleton_id").join(own, "connector_id", "left").withColumn("tags", F.coalesce("tags", F.array().cast("array<string>")))


def edges_of(links: DataFrame, key: str = "skeleton_id", a: DataFrame | None = None, b: DataFrame | None = None) -> DataFrame:
    """(source, target, weight) over connectors, by ``key``: skeletons, or fragments that are to be told apart. a, b: (key) of sources and targets."""
    pre = _only(links.where(F.col("relation") == PRE), a, key).select("connector_id", F.col(key).alias("source"))
    post = _only(links.where(F.col("relation") == POST), b, key).select("connector_id", F.col(key).alias("target"))
    return pre.join(post, "connector_id").groupBy("source", "target").agg(F.count("*").alias("weight"))


def adjacency_from_connectors(links: DataFrame, key: str = "fragment_id", a: DataFrame | None = None, b: DataFrame | None = None) -> DataFrame:
    """Adjacency of fragments as a sparse long table; pairs that aren't listed have weight 0."""
    return edges_of(links, key, a, b)


def partners_from_connectors(links: DataFrame, query: DataFrame, key: str = "fragment_id", parts: int | None = None) -> DataFrame:
    """(relation, partner, query, weight, total) of fragments, the query's own members included. Upstream leaves out connectors whose presynaptic side is in the query.

    ``parts`` are the places that links and what they make are dealt to (see ``connectivity.places``).
    """
    by = lambda df, *keys: dealt(df, parts, *keys)
    links, query = by(links, key), by(query.select(key), key)
    pre, post = links.where(F.col("relation") == PRE), links.where(F.col("relation") == POST)
    own_pre, own_post = _only(pre, query, key), _only(post, query, key)
    own_pre, own_post, pre, post = (by(df.select("connector_id", key), "connector_id") for df in (own_pre, own_post, pre, post))
    down = own_pre.select("connector_id", F.col(key).alias("query")).join(post.select("connector_id", F.col(key).alias("partner")), "connector_id")
    foreign = pre.join(own_pre.select("connector_id").distinct(), "connector_id", "left_anti")
    up = own_post.select("connector_id", F.col(key).alias("query")).join(foreign.select("connector_id", F.col(key).alias("partner")), "connector_id")
    both = down.select(F.lit("downstream").alias("relation"), "partner", "query").unionByName(up.select(F.lit("upstream").alias("relation"), "partner", "query"))
    per = by(both, "relation", "partner").groupBy("relation", "partner", "query").agg(F.count("*").alias("weight"))
    total = per.groupBy("relation", "partner").agg(F.sum("weight").alias("total"))
    return per.join(total, ["relation", "partner"])


def partners_within(links: DataFrame, inside_of: DataFrame, query: DataFrame, sizes: DataFrame, threshold: int = 1, min_size: int = 2) -> DataFrame:
    """(relation, partner, query, weight, total) over the connectors ``inside_of`` (connector_id), such as those in a volume. sizes: (skeleton_id, num_nodes)."""
    own = _only(links, inside_of, "connector_id")
    down = edges_of(own, a=query).select(F.lit("downstream").alias("relation"), F.col("target").alias("partner"), F.col("source").alias("query"), "weight")
    up = edges_of(own, b=query).select(F.lit("upstream").alias("relation"), F.col("source").alias("partner"), F.col("target").alias("query"), "weight")
    both = down.unionByName(up)
    total = both.groupBy("relation", "partner").agg(F.sum("weight").alias("total")).where(F.col("total") >= threshold)
    size = sizes.where(F.col("num_nodes") >= min_size).select(F.col("skeleton_id").alias("partner"))
    return both.join(total, ["relation", "partner"]).join(size, "partner", "left_semi").select("relation", "partner", "query", "weight", "total")
