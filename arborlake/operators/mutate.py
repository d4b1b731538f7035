"""Changes of tables as functions from tables to new tables; nothing is written in place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RELATIONS = ("presynaptic_to", "postsynaptic_to", "gapjunction_with", "abutting")


def update(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows of ``table`` with the columns of ``changes`` (key and new values) put in; unknown keys change nothing."""
    new = changes.select(key, *[F.col(c).alias(f"__new_{c}") for c in changes.columns if c != key], F.lit(True).alias("__hit"))
    out = table.join(new, key, "left")
    return out.select(*[F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in changes.columns and c != key else F.col(c) for c in table.columns])


def append_new(table: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """Adds rows whose key isn't there yet, each once."""
    return table.unionByName(rows.dropDuplicates(key).join(table, key, "left_anti").select(*table.columns))


def remove(table: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    return table.join(rows.select(*key).distinct(), key, "left_anti").select(*table.columns)


def add_tags(tags: DataFrame, new: DataFrame, override: bool = False) -> DataFrame:
    """Tags (node_id, tag) with new ones; with ``override`` those of the same nodes go first."""
    return append_new(remove(tags, new, ["node_id"]) if override else tags, new, ["node_id", "tag"])


def link_connector(links: DataFrame, new: DataFrame) -> DataFrame:
    """Adds links of known relations; others raise when the rows are read."""
    ok = F.col("relation").isin(*RELATIONS)
    checked = new.withColumn("relation", F.when(ok, F.col("relation")).otherwise(F.raise_error(F.concat(F.lit("unknown relation "), F.coalesce("relation", F.lit("null"))))))
    return links.unionByName(checked.select(*links.columns))


def add_connectors(connectors: DataFrame, new: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Adds connectors (point_id, x, y, z) unless one lies within ``tolerance`` on every axis."""
    from .spatial import cells

    size = max(2 * tolerance, 1e-9)
    a, b = cells(new, size, around=True).alias("a"), cells(connectors, size).alias("b")
    close = [F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) <= tolerance for c in "xyz"]
    known = a.join(b, [F.col(f"a.c{c}") == F.col(f"b.c{c}") for c in "xyz"]).where(close[0] & close[1] & close[2]).select(F.col("a.point_id").alias("point_id"))
    return connectors.unionByName(new.join(known, "point_id", "left_anti").select(*connectors.columns))


def diff_nodes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(node_id, state): added, deleted, moved or mutual."""
    a, b = (t.select("node_id", F.struct("x", "y", "z").alias(n)) for t, n in ((old, "a"), (new, "b")))
    state = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "deleted").when(F.col("a") != F.col("b"), "moved").otherwise("mutual")
    return a.join(b, "node_id", "full").select("node_id", state.alias("state"))


def delete_nodes(nodes: DataFrame, gone: DataFrame) -> DataFrame:
    """Without the nodes ``gone``; children of a deleted node become roots."""
    from .trees import subset

    return subset(nodes, nodes.join(gone.select("node_id").distinct(), "node_id", "left_anti"))


def set_reviewed(reviews: DataFrame, nodes: DataFrame, reviewer: str) -> DataFrame:
    """Reviews (node_id, reviewer) with one of ``reviewer`` for every node."""
    return append_new(reviews, nodes.select("node_id", F.lit(reviewer).alias("reviewer")), ["node_id", "reviewer"])


def add_nodes(nodes: DataFrame, new: DataFrame) -> DataFrame:
    """Adds nodes whose id is new; a missing radius is -1 and a missing confidence 5."""
    fixed = new.withColumns({"radius": F.coalesce("radius", F.lit(-1.0)), "confidence": F.coalesce("confidence", F.lit(5))})
    return append_new(nodes, fixed.select(*[F.col(c).cast(t).alias(c) for c, t in nodes.dtypes]), ["node_id"])


def delete_tags(tags: DataFrame, nodes: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """Tags (node_id, tag) without those of ``nodes`` (node_id): the wanted ones, or all."""
    gone = tags.join(nodes.select("node_id").distinct(), "node_id", "left_semi")
    return remove(tags, gone if wanted is None else gone.where(F.col("tag").isin(wanted)), ["node_id", "tag"])


def add_annotations(marks: DataFrame, entities: DataFrame, annotations: list[str]) -> DataFrame:
    """Marks (entity_id, annotation) with every annotation on every entity, each once. Meta-annotations are annotations of annotations."""
    new = entities.select("entity_id", F.explode(F.array(*[F.lit(a) for a in annotations])).alias("annotation"))
    return append_new(marks, new, ["entity_id", "annotation"])


def remove_annotations(marks: DataFrame, annotations: list[str], entities: DataFrame | None = None) -> DataFrame:
    """Marks without these annotations on ``entities`` (entity_id), or on all that have them."""
    gone = marks.where(F.col("annotation").isin(annotations))
    return remove(marks, gone if entities is None else gone.join(entities.select("entity_id").distinct(), "entity_id", "left_semi"), ["entity_id", "annotation"])


def rename(skeletons: DataFrame, names: DataFrame) -> DataFrame:
    """Skeletons with new names (skeleton_id, name); of several names for one the smallest counts."""
    return update(skeletons, names.groupBy("skeleton_id").agg(F.min("name").alias("name")), "skeleton_id")


def set_confidence(table: DataFrame, changes: DataFrame, key: str = "node_id") -> DataFrame:
    """Nodes or links with new confidences; one out of 1 to 5 raises when the rows are read."""
    bad = F.raise_error(F.concat(F.lit("confidence "), F.coalesce(F.col("confidence").cast("string"), F.lit("null"))))
    return update(table, changes.withColumn("confidence", F.when(F.col("confidence").between(1, 5), F.col("confidence")).otherwise(bad)), key)


def delete_unlinked(nodes: DataFrame, gone: DataFrame, links: DataFrame) -> DataFrame:
    """As ``delete_nodes``, but nodes that a connector links raise when the rows are read."""
    linked = links.select("node_id", F.lit(True).alias("linked")).distinct()
    checked = gone.select("node_id").distinct().join(linked, "node_id", "left")
    checked = checked.select(F.when(F.col("linked"), F.raise_error(F.concat(F.lit("linked node "), F.col("node_id").cast("string")))).otherwise(F.col("node_id")).cast(dict(nodes.dtypes)["node_id"]).alias("node_id"))
    return delete_nodes(nodes, checked)


def delete_neurons(table: DataFrame, skeletons: DataFrame) -> DataFrame:
    """A table of nodes, links or names without the rows of ``skeletons`` (skeleton_id)."""
    return remove(table, skeletons, ["skeleton_id"])


def apply_diff(nodes: DataFrame, new: DataFrame) -> DataFrame:
    """The differences of two versions of a skeleton put into effect: nodes added, moved and deleted; what both have alike keeps its other columns.

    ``new`` has the columns of ``nodes``. Only what ``diff_nodes`` reports changes.
    """
    state = diff_nodes(nodes, new)
    stay = nodes.join(state.where("state IN ('mutual', 'moved')").select("node_id"), "node_id", "left_semi")
    moved = new.join(state.where("state = 'moved'").select("node_id"), "node_id", "left_semi").select("node_id", "x", "y", "z")
    added = new.join(state.where("state = 'added'").select("node_id"), "node_id", "left_semi")
    return update(stay, moved, "node_id").unionByName(added.select(*nodes.columns))


def import_skeleton(nodes: DataFrame, swc: DataFrame, skeleton_id: int, first_id: int) -> DataFrame:
    """Nodes with those of an SWC table (node, parent, x, y, z, radius) of one skeleton, numbered from ``first_id`` on."""
    row = swc.select((F.col("node") + first_id).alias("node_id"), F.when(F.col("parent") >= 0, F.col("parent") + first_id).alias("parent_id"), F.lit(skeleton_id).alias("skeleton_id"), "x", "y", "z", "radius", F.lit(5).alias("confidence"))
    return nodes.unionByName(row.select(*[F.col(c).cast(t).alias(c) for c, t in nodes.dtypes]))


def transfer(source: DataFrame, target: DataFrame, skeletons: DataFrame, offset: int) -> DataFrame:
    """The target project's nodes with the given skeletons of the source, whose ids are moved by ``offset``."""
    own = source.join(skeletons.select("skeleton_id").distinct(), "skeleton_id", "left_semi")
    shifted = own.withColumns({c: F.col(c) + offset for c in ("node_id", "parent_id", "skeleton_id")})
    return target.unionByName(shifted.select(*target.columns))


def replace_skeleton(nodes: DataFrame, new: DataFrame, links: DataFrame, skeleton_id: int, radius: float | None = None) -> tuple[DataFrame, DataFrame]:
    """The skeleton's nodes replaced by ``new``, and links with their nodes moved to the nearest new one, however far. With a ``radius`` those further off become null, which the caller may refuse."""
    from .spatial import nearest
    from .stitching import nearest_any

    old = nodes.where(F.col("skeleton_id") == skeleton_id)
    used = old.join(links.select("node_id").distinct(), "node_id", "left_semi")
    point = lambda df: df.select(F.col("node_id").alias("point_id"), "x", "y", "z")
    to = (nearest_any(point(used), point(new)) if radius is None else nearest(point(used), point(new), radius)).select(F.col("a").alias("node_id"), F.col("b").alias("new_node"))
    moved = links.join(used.select("node_id", F.lit(True).alias("__old")), "node_id", "left").join(to, "node_id", "left")
    out = moved.select(*[F.when(F.col("__old"), F.col("new_node")).otherwise(F.col("node_id")).alias(c) if c == "node_id" else F.col(c) for c in links.columns])
    rest = nodes.where(F.col("skeleton_id") != skeleton_id)
    return rest.unionByName(new.select(*nodes.columns)), out


def join_nodes(nodes: DataFrame, winner: int, loser: int) -> DataFrame:
    """Two skeletons as one: the loser's is rooted at the node ``loser``, which becomes a child of ``winner``, and takes the winner's skeleton."""
    from .trees import reroot

    keep = nodes.where(F.col("node_id") == winner).select(F.col("skeleton_id").alias("__to"))
    lose = nodes.where(F.col("node_id") == loser).select("skeleton_id", F.lit(True).alias("__lost"))
    turned = reroot(nodes, loser).join(F.broadcast(lose), "skeleton_id", "left").join(F.broadcast(keep), F.lit(True))  # one row each
    parent = F.when(F.col("node_id") == loser, F.lit(winner)).otherwise(F.col("parent_id")).cast(dict(nodes.dtypes)["parent_id"])
    return turned.select(*[parent.alias(c) if c == "parent_id" else F.when(F.col("__lost"), F.col("__to")).otherwise(F.col(c)).alias(c) if c == "skeleton_id" else F.col(c) for c in nodes.columns])


def add_volume(volumes: DataFrame, name: str, mesh: DataFrame) -> DataFrame:
    """Volumes (name, face, corner, x, y, z) with the triangles of a mesh under a new name."""
    return volumes.unionByName(mesh.select(F.lit(name).alias("name"), "face", "corner", "x", "y", "z").select(*volumes.columns))


def delete_volume(volumes: DataFrame, name: str) -> DataFrame:
    return volumes.where(F.col("name") != name)
