"""Points in space: boxes, nearest neighbours on a grid, synapse placement and meshes."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Points of a neuron and kind in a cell of the smallest size that nearest ones are looked for in, and how often the reach is halved at most.
CROWD, HALVES = 16, 12


def in_box(low: tuple, high: tuple) -> Column:
    return reduce(Column.__and__, [F.col(c).between(a, b) for c, a, b in zip("xyz", low, high)])


def cells(df: DataFrame, size: float, around: bool = False) -> DataFrame:
    """Points with their grid cell, or with all 27 cells around it."""
    own = df.withColumns({f"c{c}": F.floor(F.col(c) / size) for c in "xyz"})
    if around:
        for c in "xyz":
            cell = F.col(f"c{c}")
            own = own.withColumn(f"c{c}", F.explode(F.array(cell - 1, cell, cell + 1)))
    return own


def distance(a: str, b: str) -> Column:
    return F.sqrt(sum(((F.col(f"{a}.{c}") - F.col(f"{b}.{c}")) ** 2 for c in "xyz"), F.lit(0.0)))


def within(a: DataFrame, b: DataFrame, radius: float, strict: bool = False, on: list[str] | None = None) -> DataFrame:
    """(a, b, distance) of point pairs (point_id, x, y, z) within a radius: a join of grid cells."""
    keys = [*(on or []), "cx", "cy", "cz"]
    x, y = cells(a, radius, around=True).alias("p"), cells(b, radius).alias("q")
    d = distance("p", "q")
    out = x.join(y, [F.col(f"p.{k}") == F.col(f"q.{k}") for k in keys]).select(F.col("p.point_id").alias("a"), F.col("q.point_id").alias("b"), d.alias("distance"))
    return out.where(F.col("distance") < radius if strict else F.col("distance") <= radius)


def nearest(a: DataFrame, b: DataFrame, radius: float, strict: bool = False) -> DataFrame:
    """(a, b, distance): the nearest point of ``b`` for each of ``a`` that has one within the radius; the smallest id of equals."""
    return within(a, b, radius, strict).groupBy("a").agg(F.min(F.struct("distance", "b")).alias("m")).select("a", F.col("m.b").alias("b"), F.col("m.distance").alias("distance"))


def contact_radius(distances: DataFrame, column: str = "distance", n_iqr: float = 2.0, fallback: float = 1000.0) -> DataFrame:
    """(radius): harmonic mean of link distances plus ``n_iqr`` interquartile ranges. The quartiles are exact and found by counting."""
    from .quantiles import quantiles

    d = F.col(column)
    low, high = quantiles(distances, column, [0.25, 0.75])
    return distances.agg(F.coalesce(F.try_divide(F.count(d).cast("double"), F.sum(1 / d)) + F.lit(n_iqr * ((high or 0.0) - (low or 0.0))), F.lit(fallback)).alias("radius"))


def predict_connectivity(presynapses: DataFrame, nodes: DataFrame, radius: float) -> DataFrame:
    """(source, target, weight): presynapses (point_id, source, x, y, z) whose nearest node of a target (point_id, target, x, y, z) is nearer than the radius."""
    pairs = within(presynapses, nodes, radius, strict=True).select(F.col("a").alias("point_id"), F.col("b").alias("node"))
    full = pairs.join(presynapses.select("point_id", "source"), "point_id").join(nodes.select(F.col("point_id").alias("node"), "target"), "node")
    return full.groupBy("source", "target").agg(F.count_distinct("point_id").alias("weight"))


def synapse_similarity(points: DataFrame, sigma: float = 2000.0, omega: float = 2000.0, reach: float | None = 8.0) -> DataFrame:
    """(a, b, similarity) of every ordered pair of neurons by where their synapses lie. points: point_id, neuron, kind, x, y, z.

    Each synapse of A is compared with the nearest of B of its kind: how near it is, and
    how alike the numbers of synapses of that kind within ``omega`` are, both counts
    taken with the point itself. Kinds that B lacks count 0. Neighbours are looked for in grid cells, of
    ``omega`` for the counts and of ``reach`` times ``sigma`` for the nearest: what lies further off than eight would add less than 2e-14.
    Without a ``reach`` every point looks for its nearest of each neuron at any distance, which takes a row for each point and neuron of its kind.
    """
    p = points.select("point_id", "neuron", "kind", "x", "y", "z")

    x = cells(p, omega, around=True)
    y = cells(p, omega).select(*[F.col(c).alias(f"o_{c}") for c in "xyz"], "neuron", "kind", "cx", "cy", "cz")
    close = x.join(y, ["neuron", "kind", "cx", "cy", "cz"]).where(_to_other() <= omega)
    own = close.groupBy("point_id").agg(F.count("*").alias("own"))
    if reach is None:
        per = _nearest_of_each(p)
    else:
        per = _nearest_within(p, reach * sigma)
    scored = per.join(own.withColumnRenamed("own", "mine"), "point_id").join(own.withColumnRenamed("point_id", "n"), "n")
    score = F.exp(-F.abs(F.col("mine") - F.col("own")) / (F.col("mine") + F.col("own"))) * F.exp(-(F.col("d") ** 2) / (2 * sigma**2))
    sums = scored.groupBy("a", "b").agg(F.sum(score).alias("s"))
    size = p.groupBy(F.col("neuron").alias("a")).agg(F.count("*").alias("size"))
    # the result has a row for each ordered pair of the given neurons
    grid = size.join(p.select(F.col("neuron").alias("b")).distinct(), F.lit(True))
    return grid.join(sums, ["a", "b"], "left").select("a", "b", (F.coalesce("s", F.lit(0.0)) / F.col("size")).alias("similarity"))


def _to_other() -> Column:
    return F.sqrt(sum(((F.col(c) - F.col(f"o_{c}")) ** 2 for c in "xyz"), F.lit(0.0)))


def _nearest_within(p: DataFrame, reach: float) -> DataFrame:
    """(point_id, a, b, d, n): the nearest point of the same kind within ``reach`` of every neuron that has one there; the smallest id of equals.

    Points look around themselves in small cells first, as wide as to hold few points of a neuron and kind. What lies within a cell's width is the
    nearest; who has found none of a neuron looks for it again in cells twice as wide, at last in those of ``reach``.
    """
    from .trees import cut

    p = p.where("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL")
    # points of one neuron and kind in one place have one answer and stand for one another by the smallest id
    one = cut(p.groupBy("neuron", "kind", "x", "y", "z").agg(F.min("point_id").alias("point_id")))
    crowds = [cells(one, reach / 2**k).groupBy("neuron", "kind", "cx", "cy", "cz").count().agg(F.lit(k).alias("k"), F.max("count").alias("most")) for k in range(HALVES + 1)]
    last = min((r["k"] for r in reduce(DataFrame.unionByName, crowds).collect() if (r["most"] or 0) <= CROWD), default=HALVES)  # a row a level
    left = one.join(one.select("kind", F.col("neuron").alias("b")).distinct(), "kind").select("point_id", "kind", "b", "x", "y", "z")
    found = None
    for k in range(last, -1, -1):
        size = reach / 2**k
        y = cells(one, size).select(F.col("point_id").alias("n"), F.col("neuron").alias("b"), "kind", *[F.col(c).alias(f"o_{c}") for c in "xyz"], "cx", "cy", "cz")
        pair = cells(left, size, around=True).join(y, ["kind", "b", "cx", "cy", "cz"]).withColumn("d", _to_other())
        # a little less than the width, for what rounding may move into a cell further off
        near = pair.where(F.col("d") <= (size * (1 - 1e-9) if k else size)).groupBy("point_id", "b").agg(F.min(F.struct("d", "n")).alias("m"))
        near = cut(near.select(F.col("point_id").alias("first"), "b", "m.d", "m.n"))
        found = near if found is None else found.unionByName(near)
        if k:
            left = cut(left.join(near.withColumnRenamed("first", "point_id"), ["point_id", "b"], "left_anti"))
    own = p.join(one.withColumnRenamed("point_id", "first"), ["neuron", "kind", "x", "y", "z"]).select("point_id", "first", F.col("neuron").alias("a"))
    return own.join(found, "first").select("point_id", "a", "b", "d", "n")


def _nearest_of_each(p: DataFrame) -> DataFrame:
    """(point_id, a, b, d, n): the nearest point of the same kind of every neuron that has the kind, at any distance; the smallest id of equals."""
    from .stitching import closest
    from .trees import cut

    # points of one neuron and kind in one place have one answer and stand for one another by the smallest id
    p = p.where("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL")
    one = cut(p.groupBy("neuron", "kind", "x", "y", "z").agg(F.min("point_id").alias("point_id")))
    owners = one.select("kind", F.col("neuron").alias("b")).distinct()
    asks = one.join(owners, "kind").select(F.struct("point_id", "b").alias("grp"), "point_id", "kind", F.col("b").alias("of"), "x", "y", "z")
    of = one.select(F.lit(None).cast(dict(asks.dtypes)["grp"]).alias("own"), "point_id", "kind", F.col("neuron").alias("of"), "x", "y", "z")
    found = closest(asks, of, ties=True, on=["kind", "of"], smallest=True)
    found = found.select(F.col("grp.point_id").alias("first"), "grp.b", F.col("distance").alias("d"), F.col("b").alias("n"))
    own = p.join(one.withColumnRenamed("point_id", "first"), ["neuron", "kind", "x", "y", "z"]).select("point_id", "first", F.col("neuron").alias("a"))
    return own.join(found, "first").select("point_id", "a", "b", "d", "n")


def mutual(similarities: DataFrame) -> DataFrame:
    """Means of both directions."""
    back = similarities.select(F.col("a").alias("b"), F.col("b").alias("a"), F.col("similarity").alias("back"))
    return similarities.join(back, ["a", "b"]).select("a", "b", ((F.col("similarity") + F.col("back")) / 2).alias("similarity"))


def in_mesh(points: DataFrame, vertices: np.ndarray, faces: np.ndarray) -> DataFrame:
    """Points inside a closed mesh of the caller's, by the parity of crossings of an upward ray. Points on the surface may count either way."""
    from .meshes import in_volumes, volume_of

    inside = in_volumes(points, volume_of(points, vertices, faces))
    return points.join(inside.select("point_id"), "point_id", "left_semi")


def union_neurons(base: DataFrame, other: DataFrame, limit: float) -> DataFrame:
    """Nodes of ``other`` within ``limit`` of a node of ``base`` collapse onto the nearest; the rest is added with its parents rewired. A collapsed node's parent link goes."""
    a = other.select(F.col("node_id").alias("point_id"), "x", "y", "z")
    b = base.select(F.col("node_id").alias("point_id"), "x", "y", "z")
    onto = nearest(a, b, limit).select(F.col("a").alias("old"), F.col("b").alias("new"))
    kept = other.join(onto, other["node_id"] == F.col("old"), "left_anti")
    moved = kept.join(onto.withColumnRenamed("old", "parent_id"), "parent_id", "left").withColumn("parent_id", F.coalesce("new", "parent_id"))
    return base.unionByName(moved.select(*base.columns))


def virtual_nodes(nodes: DataFrame, z_step: float) -> DataFrame:
    """Nodes between a node and its parent at the sections it skips, by linear interpolation: (node_id, step, x, y, z)."""
    a, b = nodes.alias("a"), nodes.alias("b")
    pair = a.join(b, F.col("a.parent_id") == F.col("b.node_id")).select("a.node_id", *[F.col(f"a.{c}").alias(f"{c}0") for c in "xyz"], *[F.col(f"b.{c}").alias(f"{c}1") for c in "xyz"])
    n = F.round(F.abs(F.col("z1") - F.col("z0")) / z_step).cast("int")
    rows = pair.withColumn("n", n).where("n > 1").withColumn("step", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
    part = F.col("step") / F.col("n")
    return rows.select("node_id", "step", *[(F.col(f"{c}0") + part * (F.col(f"{c}1") - F.col(f"{c}0"))).alias(c) for c in "xyz"])


def tiles(boxes: DataFrame, width: int, height: int, resolution: tuple[float, float, float], zoom: int = 0) -> DataFrame:
    """(box_id, z, row, col, left, top): the image tiles of boxes (box_id, x1, x2, y1, y2, z1, z2), a row a tile; left and top are pixels to crop."""
    px = lambda c, i: F.floor(F.col(c) / (resolution[i] * 2**zoom) + 0.5).cast("long")
    b = boxes.select("box_id", px("x1", 0).alias("x1"), px("x2", 0).alias("x2"), px("y1", 1).alias("y1"), px("y2", 1).alias("y2"), F.floor(F.col("z1") / resolution[2] + 0.5).cast("long").alias("z1"), F.floor(F.col("z2") / resolution[2] + 0.5).cast("long").alias("z2"))
    rows = b.withColumn("z", F.explode(F.sequence("z1", "z2"))).withColumn("col", F.explode(F.sequence(F.floor(F.col("x1") / width), F.floor(F.col("x2") / width))))
    rows = rows.withColumn("row", F.explode(F.sequence(F.floor(F.col("y1") / height), F.floor(F.col("y2") / height))))
    return rows.select("box_id", "z", "row", "col", (F.col("x1") - F.floor(F.col("x1") / width) * width).alias("left"), (F.col("y1") - F.floor(F.col("y1") / height) * height).alias("top"))


def rank_nearest(a: DataFrame, b: DataFrame, radius: float, k: int) -> DataFrame:
    """The ``k`` nearest within a radius."""
    order = Window.partitionBy("a").orderBy("distance", "b")
    return within(a, b, radius).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
