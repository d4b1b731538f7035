"""Neurons as they were at a time, from the versions of their nodes, connectors, tags and annotations.

A version is valid from ``created`` to ``modified``; one created after it was modified is the current one, and one with both
alike was never there. Times are of any type that can be compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .trees import cut, fragments, subset


def valid(at: Column) -> Column:
    return (F.col("created") <= at) & ((F.col("modified") >= at) | (F.col("created") > F.col("modified"))) & (F.col("created") != F.col("modified"))


def nodes_at(versions: DataFrame, at: Column) -> DataFrame:
    """Nodes (with any columns but the times) of each skeleton_id as they were; of several valid versions of a node the last one counts.

    Nodes whose parent wasn't there become roots. Of a skeleton with several roots only one piece stays: that of the one root which
    was no child in the first version that lasted beyond ``at``; where none or several are such roots, the largest piece (of equals that of the smallest
    root). Pieces that were joined later are not yet part of the neuron.
    """
    columns = [c for c in versions.columns if c not in ("created", "modified")]
    rest = [c for c in columns if c != "node_id"]
    now = versions.where(valid(at)).groupBy("node_id").agg(F.max_by(F.struct(*rest), "created").alias("v")).select("node_id", "v.*")
    now = cut(subset(now, now))
    piece = cut(fragments(now).join(now.select("node_id", "skeleton_id"), "node_id"))
    root = piece.groupBy("skeleton_id", "root").agg(F.count("*").alias("n"))
    lasts = versions.where((F.col("modified") > at) | (F.col("created") > F.col("modified"))).where(F.col("created") != F.col("modified"))
    first = lasts.groupBy(F.col("node_id").alias("root")).agg(F.min_by(F.struct("parent_id"), "created").alias("v")).select("root", F.col("v.parent_id").isNotNull().alias("child"))
    root = root.join(first, "root", "left").withColumn("real", (~F.coalesce("child", F.lit(False))).cast("int"))
    best = lambda when: F.min(F.when(when, F.struct(-F.col("n"), "root")))
    chosen = root.groupBy("skeleton_id").agg(F.sum("real").alias("reals"), best(F.lit(True)).alias("largest"), best(F.col("real") == 1).alias("one"))
    chosen = chosen.select(F.when(F.col("reals") == 1, F.col("one.root")).otherwise(F.col("largest.root")).alias("root"))
    kept = piece.join(chosen, "root", "left_semi").select("node_id")
    return now.join(kept, "node_id", "left_semi").select(*columns)


def connectors_at(versions: DataFrame, links: DataFrame, nodes: DataFrame, at: Column) -> DataFrame:
    """Versions of connectors (connector_id, node_id, and any others) that were valid, on ``nodes`` (node_id) of that time, and linked by then: ``links`` has connector_id, node_id, created."""
    linked = links.where(F.col("created") <= at).select("connector_id", "node_id").distinct()
    out = versions.where(valid(at)).join(nodes.select("node_id"), "node_id", "left_semi").join(linked, ["connector_id", "node_id"], "left_semi")
    return out.select(*[c for c in versions.columns if c not in ("created", "modified")])


def marks_at(marks: DataFrame, at: Column) -> DataFrame:
    """Tags or annotations (with ``created``) that were set by then; when one was taken away isn't known, so it counts as set."""
    return marks.where(F.col("created") <= at)


def rewind(at: Column, nodes: DataFrame, connectors: DataFrame | None = None, links: DataFrame | None = None, tags: DataFrame | None = None, annotations: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables of the neurons as they were: nodes, and whichever of connectors (with ``links``), tags and annotations are given."""
    out = {"nodes": cut(nodes_at(nodes, at))}
    if connectors is not None:
        if links is None:
            raise ValueError("connectors need links")
        out["connectors"] = connectors_at(connectors, links, out["nodes"], at)
    for name, table in (("tags", tags), ("annotations", annotations)):
        if table is not None:
            out[name] = marks_at(table, at)
    return out
