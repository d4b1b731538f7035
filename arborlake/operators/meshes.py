"""Points in closed meshes, with the faces as a table.

A volume is a set of triangles (name, face, corner, x, y, z). A point is inside if a ray upwards meets its faces an odd
number of times. Faces are put into every x,y cell that their outline touches, points into theirs, so the
only pairs made are those of one column; no mesh is sent to the tasks or held in one.

Rays through an edge or a corner are decided as if the point lay a little to the right and even less further up. Each edge is looked at from its
smaller end, so that both faces beside it agree exactly, and a ray meets a closed surface once wherever it passes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .trees import cut, subset

VOLUME = "name string, face long, corner int, x double, y double, z double"


def triangles(volumes: DataFrame) -> DataFrame:
    """(name, face, ax, ay, az, bx, ..., cz): a row a face that has an area when seen from above; incomplete faces are left out."""
    corners = volumes.where("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL")
    rows = corners.groupBy("name", "face").agg(F.array_sort(F.collect_list(F.struct("corner", "x", "y", "z"))).alias("p")).where(F.size("p") == 3)
    rows = rows.select("name", "face", *[F.col("p")[i][c].cast("double").alias(f"{k}{c}") for i, k in enumerate("abc") for c in "xyz"])
    return rows.where(F.expr("(bx - ax) * (cy - ay) - (by - ay) * (cx - ax) <> 0"))


def _side(p: str, q: str) -> Column:
    """+1 or -1: on which side of the edge from corner p to q the point x, y is, never 0."""
    px, py, qx, qy = (F.col(f"{k}{c}") for k in (p, q) for c in "xy")
    turned = (px > qx) | ((px == qx) & (py > qy))
    x1, y1, x2, y2 = F.when(turned, qx).otherwise(px), F.when(turned, qy).otherwise(py), F.when(turned, px).otherwise(qx), F.when(turned, py).otherwise(qy)
    area = (x2 - x1) * (F.col("y") - y1) - (y2 - y1) * (F.col("x") - x1)
    sign = F.when(area != 0, F.signum(area)).when(y2 != y1, F.signum(y1 - y2)).otherwise(F.signum(x2 - x1))
    return F.when(turned, -sign).otherwise(sign)


def in_volumes(points: DataFrame, volumes: DataFrame) -> DataFrame:
    """(name, point_id): the points (point_id, x, y, z) inside each volume. Points on the surface may count either way; without a position they are in none."""
    face = cut(triangles(volumes))
    low, high = {c: F.least(*[f"{k}{c}" for k in "abc"]) for c in "xyz"}, {c: F.greatest(*[f"{k}{c}" for k in "abc"]) for c in "xyz"}
    width, height = high["x"] - low["x"], high["y"] - low["y"]
    mean = face.agg(F.avg(width).alias("w"), F.avg(height).alias("h"), F.avg(width * height).alias("a")).first()
    out = points.select("point_id", *[F.col(c).cast("double").alias(c) for c in "xyz"]).where("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL")
    if not mean["a"]:
        return out.select(F.lit(None).cast("string").alias("name"), "point_id").limit(0)
    # with cells of this size faces fill four cells each on average, whatever their sizes are
    scale = max(1.0, mean["a"] / (mean["w"] * mean["h"])) ** 0.5
    wide, high_ = mean["w"] * scale, mean["h"] * scale
    i_of, j_of = (lambda v: F.floor(v / wide).cast("long")), (lambda v: F.floor(v / high_).cast("long"))
    spread = face.withColumn("top", high["z"]).withColumn("i", F.explode(F.sequence(i_of(low["x"]), i_of(high["x"])))).withColumn("j", F.explode(F.sequence(j_of(low["y"]), j_of(high["y"]))))
    pairs = out.withColumns({"i": i_of(F.col("x")), "j": j_of(F.col("y"))}).join(spread, ["i", "j"]).where("top > z")
    sides = [_side(p, q) for p, q in ("ab", "bc", "ca")]
    pairs = pairs.where((sides[0] == sides[1]) & (sides[1] == sides[2]))
    # the face's height above the point
    area = F.expr("(bx - ax) * (cy - ay) - (by - ay) * (cx - ax)")
    u, v = F.expr("(x - ax) * (cy - ay) - (y - ay) * (cx - ax)") / area, F.expr("(bx - ax) * (y - ay) - (by - ay) * (x - ax)") / area
    above = F.col("az") + u * (F.col("bz") - F.col("az")) + v * (F.col("cz") - F.col("az")) > F.col("z")
    return pairs.where(above).groupBy("name", "point_id").agg(F.count("*").alias("n")).where("n % 2 = 1").select("name", "point_id")


def volume_of(df: DataFrame, vertices: np.ndarray, faces: np.ndarray, name: str = "mesh") -> DataFrame:
    """A volume from the caller's arrays of corners and faces, in the session of ``df``."""
    v, f = np.asarray(vertices, float), np.asarray(faces, int)
    rows = [(name, i, k, *map(float, v[j])) for i, face in enumerate(f.tolist()) for k, j in enumerate(face)]
    return df.sparkSession.createDataFrame(rows, VOLUME)


def prune_by_volume(nodes: DataFrame, volumes: DataFrame, keep: str = "IN") -> DataFrame:
    """Nodes inside any of the volumes, or with ``keep="OUT"`` those inside none; children of nodes that are gone become roots."""
    if keep not in ("IN", "OUT"):
        raise ValueError(keep)
    inside = in_volumes(nodes.select(F.col("node_id").alias("point_id"), "x", "y", "z"), volumes).select(F.col("point_id").alias("node_id")).distinct()
    return subset(nodes, nodes.join(inside, "node_id", "left_semi" if keep == "IN" else "left_anti"))


def skeletons_in_volumes(nodes: DataFrame, volumes: DataFrame, min_nodes: int = 1) -> DataFrame:
    """(name, skeleton_id, n): skeletons with at least so many nodes in a volume."""
    inside = in_volumes(nodes.select(F.col("node_id").alias("point_id"), "x", "y", "z"), volumes)
    own = nodes.select(F.col("node_id").alias("point_id"), "skeleton_id")
    return inside.join(own, "point_id").groupBy("name", "skeleton_id").agg(F.count("*").alias("n")).where(F.col("n") >= min_nodes)
