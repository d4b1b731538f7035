"""Operator 12: k-means in integers, with distances by matrix products.

A kept vector's components become integers, floor(scale * x). Distances of a block of vectors to all centroids are
|x|^2 - 2 x.c + |c|^2, one BLAS product of float64 a block. All its numbers are integers, so it is exact as long as
no sum reaches 2^53: with components of at most m and centroids of at most c in magnitude, d (m + c)^2 bounds them. A
row of vectors beyond that is computed in Python's integers instead, with the same result as far as
both go. Components are scaled anew in each pass from the vectors as they are, so that nothing is rounded.

Each pass maps the vectors, where they lie, to a partial result a task (sums, counts and distances of each
cluster as integers of any size); ``treeAggregate`` adds these up in steps, so the driver gets a few kilobytes
whatever the number of tasks. Vectors are never shuffled. Assignment ends early once a round changes no centroid, as all later
rounds would be alike.

Nulls: vectors that are null, of another length, or with null or non-finite components are left out. A
vector without vec_id is assigned like any other, but begins as a centroid only if there are too few others. Repeated rows
have a row each, and of rows whose hashes tie the first begins by its components. With fewer vectors than ``k`` there are fewer centroids; an
empty table gives no rows. A distance or sum beyond 64 bits is null. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch

#: Sums of integers are exact in float64 below this.
EXACT = 1 << 53
BLOCK = 8192
OUT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
_LONG = (1 << 63) - 1


def whole(x: float, scale: int) -> int:
    """floor(scale * x), also where the product is beyond float64."""
    return math.floor(x) * scale if abs(x) >= EXACT else math.floor(scale * x)


def measured(x: np.ndarray, centroids: np.ndarray, scale: int):
    """(rows, their nearest centroids, squared distances, integer components): first the rows that float64 holds exactly, of dtype int64, then the others, of dtype object."""
    with np.errstate(over="ignore"):
        v = np.floor(x * scale)
        most = np.abs(v).max(1, initial=0) + float(min(max((abs(c) for c in centroids.flat), default=0), EXACT))
        exact = x.shape[1] * most * most < EXACT
    if exact.any():
        u, c = v[exact], centroids.astype(np.float64)
        d = (u * u).sum(1)[:, None] - 2 * (u @ c.T) + (c * c).sum(1)
        nearest = d.argmin(1)
        yield np.flatnonzero(exact), nearest, d[np.arange(len(u)), nearest].astype(np.int64), u.astype(np.int64)
    if not exact.all():
        rows = [[whole(a, scale) for a in row] for row in x[~exact].tolist()]
        found = [min((sum((a - b) ** 2 for a, b in zip(row, c)), i) for i, c in enumerate(centroids.tolist())) for row in rows]
        yield np.flatnonzero(~exact), np.array([i for _, i in found]), np.array([d for d, _ in found], object), np.array(rows, object)


def blocks(batches, d: int):
    """Parts of ``BLOCK`` rows of batches, and their vectors as float64."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, np.asarray(part.column("v").flatten(), np.float64).reshape(-1, d)


def kept(vectors: DataFrame, d: int, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, v) of vectors with exactly ``d`` components, none null or non-finite."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).alias("v"))
    kind = rows.schema["v"].dataType.elementType.simpleString()
    rows = rows if kind in ("float", "double") else rows.withColumn("v", F.col("v").cast("array<double>"))
    return rows.where("v IS NOT NULL").where(F.size("v") == d).where("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")


def start(rows: DataFrame, k: int, seed: int, scale: int) -> np.ndarray:
    """The ``k`` vectors of smallest hash, as integers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(digest.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([[whole(x, scale) for x in r["v"]] for r in first], object)


def totals(rows: DataFrame, centroids: np.ndarray, scale: int, depth: int = 2) -> list[tuple[int, int, list[int]]]:
    """Per cluster: vectors, sum of distances, componentwise sums; exact."""
    k, d = centroids.shape

    def part(batches):
        n, inertia, sums = [0] * k, [0] * k, np.zeros((k, d), object)
        for _, x in blocks(batches, d):
            for _, nearest, far, v in measured(x, centroids, scale):
                for i in np.unique(nearest).tolist():
                    own = nearest == i
                    n[i] += int(own.sum())
                    inertia[i] += sum(far[own].tolist())
                    sums[i] += v[own].sum(0).astype(object)  # of a block's components within 2^27: exact in 64 bits
        yield pa.RecordBatch.from_pydict({"part": pa.array([pickle.dumps((n, inertia, sums.tolist()))], pa.binary())})

    def add(a, b):
        if not a or not b:
            return a or b
        return ([x + y for x, y in zip(a[0], b[0])], [x + y for x, y in zip(a[1], b[1])], [[x + y for x, y in zip(r, s)] for r, s in zip(a[2], b[2])])

    parts = rows.select("v").mapInArrow(part, "part binary").rdd.map(lambda r: pickle.loads(r[0]))
    n, inertia, sums = parts.treeAggregate((), add, add, depth) or ([0] * k, [0] * k, [[0] * d] * k)
    return list(zip(n, inertia, sums))


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, d: int = 64, scale: int = 256, seed: int = 2, key: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256; and the centroids."""
    rows = Scratch(vectors.sparkSession, "centroids").keep(kept(vectors, d, key, column), "vectors")
    centroids = start(rows, k, seed, scale)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], OUT), centroids.reshape(0, d)
    found = totals(rows, centroids, scale)
    for _ in range(rounds):
        # // is floor for negative sums too
        moved = np.array([[s // n for s in sums] if n else list(old) for (n, _, sums), old in zip(found, centroids)], object)
        if (moved == centroids).all():
            break
        centroids = moved
        found = totals(rows, centroids, scale)
    fits = lambda x: x if x <= _LONG else None
    inertia, everything = [fits(f[1]) for f in found], fits(sum(f[1] for f in found))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def assign(batches):
        for part, x in blocks(batches, d):
            at, far = [0] * len(x), [0] * len(x)
            for rows_, nearest, distance, _ in measured(x, centroids, scale):
                for i, c, f in zip(rows_.tolist(), nearest.tolist(), distance.tolist()):
                    at[i], far[i] = c, fits(f)
            columns = [part.column("vec_id"), pa.array(at, pa.int32()), pa.array(far, pa.int64()), pa.array([inertia[i] for i in at], pa.int64()), pa.array([everything] * len(at), pa.int64()), pa.array([digests[i] for i in at], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return rows.mapInArrow(assign, OUT), centroids


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))[0]
