"""The union of any number of neurons that overlap, as one tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spatial import distance
from .stitching import join_skeletons, reroot_edges, spanning
from .trees import cut, fragments, reroot_all, subset, to_root


def collapsed(nodes: DataFrame, order: DataFrame, limit: float) -> DataFrame:
    """(node_id, into): nodes within ``limit`` of a node of a neuron that stands before theirs in ``order`` (skeleton_id, rank), and the node they end up in.

    A node goes into the nearest such node (the smallest id of equals), and where that goes into another one, so does it.
    """
    from .spatial import cells

    ranked = nodes.join(order, "skeleton_id").select("node_id", "rank", "x", "y", "z").where("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL")
    a, b = cells(ranked, limit, around=True).alias("p"), cells(ranked, limit).alias("q")
    pair = a.join(b, [F.col(f"p.c{c}") == F.col(f"q.c{c}") for c in "xyz"]).where("q.rank < p.rank")
    pair = pair.select(F.col("p.node_id").alias("node_id"), F.col("q.node_id").alias("other"), distance("p", "q").alias("d")).where(F.col("d") <= limit)
    near = cut(pair.groupBy("node_id").agg(F.min(F.struct("d", "other")).alias("m")).select("node_id", F.col("m.other").alias("parent_id")))
    # ranks fall along these pointers, so they end
    ends = near.select(F.col("parent_id").alias("node_id")).distinct().join(near, "node_id", "left_anti").withColumn("parent_id", F.lit(None).cast(dict(near.dtypes)["parent_id"]))
    way = to_root(near.unionByName(ends), F.lit(0.0))
    return way.where("node_id <> root").select("node_id", F.col("root").alias("into"))


def union_all(nodes: DataFrame, limit: float, base: int | None = None, non_overlap: str = "raise", connectors: DataFrame | None = None, tags: DataFrame | None = None) -> dict[str, DataFrame]:
    """Tables ``nodes``, ``merged`` (node_id, into) and whichever of ``connectors`` and ``tags`` (node_id, and any others) are given, for the union of all neurons of ``nodes``.

    The neuron ``base`` (a skeleton_id, by default the smallest) comes first and keeps its nodes, its root and its links, the others follow by their
    ids. Nodes of later neurons within ``limit`` of earlier ones collapse (see ``collapsed``); what hung on them hangs on the node they went into. Of the
    links that would close a ring those of later neurons are left out, within a neuron those of larger nodes. Connectors and tags follow their nodes, tags
    once each. What has no overlap with the base: ``raise`` an error, ``skip`` it, or ``stitch`` it on by the shortest new edges between roots and ends.
    """
    if non_overlap not in ("raise", "skip", "stitch"):
        raise ValueError(non_overlap)
    base = nodes.agg(F.min("skeleton_id")).first()[0] if base is None else base
    if base is None or nodes.where(F.col("skeleton_id") == base).isEmpty():
        raise ValueError(f"no neuron {base}")
    order = nodes.select("skeleton_id").distinct().withColumn("rank", F.when(F.col("skeleton_id") == base, F.struct(F.lit(0).alias("later"), F.lit(0).cast("long").alias("id"))).otherwise(F.struct(F.lit(1).alias("later"), F.col("skeleton_id").cast("long").alias("id"))))
    merged = cut(collapsed(nodes, order, limit))
    stay = cut(subset(nodes, nodes.join(merged, "node_id", "left_anti")))
    piece = cut(fragments(stay).select(F.col("node_id"), F.col("root").alias("grp")))

    # links one or both of whose nodes collapsed, between what their nodes went into
    ends = nodes.where("parent_id IS NOT NULL").join(order, "skeleton_id").select("node_id", "parent_id", "rank")
    to = lambda key, name: merged.select(F.col("node_id").alias(key), F.col("into").alias(name))
    moved = ends.join(to("node_id", "__a"), "node_id", "left").join(to("parent_id", "__b"), "parent_id", "left").where("__a IS NOT NULL OR __b IS NOT NULL")
    moved = moved.select("rank", F.col("node_id").alias("link"), F.coalesce("__a", "node_id").alias("a"), F.coalesce("__b", "parent_id").alias("b")).where("a <> b")
    of = lambda key: piece.select(F.col("node_id").alias(key), F.col("grp").alias(f"g{key}"))
    links = moved.join(of("a"), "a").join(of("b"), "b").where("ga <> gb")
    links = cut(links.select("rank", "link", "a", "b", "ga", "gb").unionByName(links.select("rank", "link", F.col("b").alias("a"), F.col("a").alias("b"), F.col("gb").alias("ga"), F.col("ga").alias("gb"))))

    def first_link(root: DataFrame) -> DataFrame:
        """Of each tree of pieces the first link to another one. The order is total over links, so only two that choose one another make a ring."""
        at = lambda key: root.select(F.col("grp").alias(f"g{key}"), F.col("root").alias(f"r{key}"))
        out = links.join(at("a"), "ga").join(at("b"), "gb").where("ra <> rb")
        return out.groupBy(F.col("ra").alias("root")).agg(F.min(F.struct("rank", "link", "a", "b", "ga", "gb", "rb")).alias("m")).select("root", "m.a", "m.b", F.col("m.ga").alias("from"), F.col("m.gb").alias("to"), F.col("m.rb").alias("next"))

    tree = cut(spanning(piece.select("grp").distinct(), first_link))
    top = stay.where((F.col("skeleton_id") == base) & F.col("parent_id").isNull()).agg(F.min("node_id")).first()[0]
    edges = cut(reroot_edges(tree, top))
    hung = reroot_all(stay, edges.select(F.col("a").alias("node_id"))).join(edges.select(F.col("a").alias("node_id"), F.col("b").alias("__onto")), "node_id", "left")
    out = cut(hung.withColumn("parent_id", F.coalesce("parent_id", "__onto")).select(*nodes.columns))
    whole = cut(fragments(out).join(out.select("node_id", "skeleton_id"), "node_id"))
    # the base's own pieces are part of it, joined or not
    own = whole.where(F.col("skeleton_id") == base).select("root").distinct()
    apart = whole.join(own, "root", "left_anti")
    if not apart.isEmpty():
        if non_overlap == "raise":
            raise ValueError(f"no overlap: {sorted(r[0] for r in apart.select('skeleton_id').distinct().limit(20).collect())}")
        if non_overlap == "skip":
            out = out.join(whole.join(own, "root", "left_semi").select("node_id"), "node_id", "left_semi")
        else:
            out = join_skeletons(out, base, "LEAFS")
    result = {"nodes": out.withColumn("skeleton_id", F.lit(base).cast(dict(nodes.dtypes)["skeleton_id"])).select(*nodes.columns), "merged": merged}
    kept = result["nodes"].select("node_id")
    for name, table in (("connectors", connectors), ("tags", tags)):
        if table is not None:
            follows = table.join(merged.withColumnRenamed("into", "__into"), "node_id", "left").withColumn("node_id", F.coalesce("__into", "node_id")).join(kept, "node_id", "left_semi").select(*table.columns)
            result[name] = follows.distinct() if name == "tags" else follows
    return result
