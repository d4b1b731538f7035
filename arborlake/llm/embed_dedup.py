"""Operator 5: embedding near-duplicates by randomised-rotation binary codes.

A vector is made a unit vector and rotated at random. Its code is the signs of the
rotated components; stored beside it is the correction factor f, the inner product of
the rotated vector and its code (as a unit vector). For another unit vector q,
<code, rotated q> / f is an unbiased estimate of <x, q>; its error is within
``sigmas * sqrt((1 - f^2) / f^2 / (d - 1))``. ``TURNS`` independent rotations are averaged,
which halves that bound. An estimate takes the code of one vector and the other vector;
pairs whose upper bound is below the threshold are dropped, and only for the others
the second vector is fetched and the cosine computed exactly, in double precision.

Candidates share a band: ``bits`` signs out of ``bands`` further random rotations. ``bits``
follows the largest label's number of vectors, ``bands`` the miss probability ``miss`` for
a pair at the threshold itself (any closer pair is missed less often). A pair that shares
one of the ``LOOK_BACK`` bands before a band is passed over there: the first band it shares
never has one, so none is lost. Of the pairs in a band, those whose codes differ in more
signs than ``sigmas`` standard deviations above the mean at the threshold are dropped.
All these are joins on the JVM; no group of a band is gathered anywhere.

Vectors with equal components and label form a class, which goes on as one row, so
copies aren't expanded into pairs. Links between different vectors of a dense group are
all found, as their number is part of the result.

Nulls: a null label, a null or empty vector, one of zeros or with a null or non-finite
component links with nothing; neither does a row without vec_id (its component is null,
and it is kept). Only vectors of equal length are compared. A cosine of exactly the threshold
links; of equal vectors the smallest vec_id stands for all. Repeated rows of one vec_id count
as one vector for components, with the most links that any of them has, and have their rows each. An
empty table gives no rows. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .scratch import Scratch
from .textvec import constants, mix

SIGMAS, MISS = 5.5, 1e-6
#: Rotations of a code; their estimates are averaged. / Bands before one that are compared with it.
TURNS, LOOK_BACK = 4, 4


_rotations: dict[tuple[int, int], np.ndarray] = {}


def rotation(d: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    if (seed, d) not in _rotations:
        if len(_rotations) >= 128:
            _rotations.clear()
        q, r = np.linalg.qr(np.random.default_rng([seed + 1000, d]).standard_normal((d, d)))
        _rotations[seed, d] = q * np.sign(np.diag(r))
    return _rotations[seed, d]


def bands_of(rows: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Bits of a band and number of bands for labels of up to ``rows`` vectors."""
    bits = min(40, max(6, math.ceil(math.log2(max(rows, 2))) + 1))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-same)) if same < 1 else 1


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign codes (64-bit words, a row a vector) and correction factors of unit vectors."""
    y = x @ turn
    packed = np.packbits(y >= 0, axis=1, bitorder="little")
    wide = np.zeros((len(x), -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view(np.int64), np.abs(y).sum(1) / math.sqrt(x.shape[1])


def estimate(signs: np.ndarray, f: np.ndarray, q: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of inner products and the half widths of their bounds. signs: +1 and -1."""
    d = q.shape[1]
    inner = (signs * (q @ turn)).sum(1) / math.sqrt(d) / f
    return inner, SIGMAS * np.sqrt(np.maximum(1 - f * f, 0) / (f * f) / max(d - 1, 1))


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    x = np.stack(column.to_numpy(zero_copy_only=False)).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True), x


def near(vectors: DataFrame, threshold: float = 0.93, miss: float = MISS, sigmas: float = SIGMAS) -> DataFrame:
    """Per row: vec_id, n_links, component_id and kept. ``miss`` and ``sigmas`` set how many links at the threshold itself may be lost."""
    scratch = Scratch(vectors.sparkSession, "embed-dedup")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label"), F.col("embedding").cast("array<double>").alias("v"))
    ok = F.expr("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)")
    rows = rows.withColumn("ok", F.coalesce(ok, F.lit(False)))
    # -0.0 and 0.0 are equal
    rows = rows.withColumn("v", F.when(F.col("ok"), F.expr("transform(v, x -> CASE WHEN x = 0 THEN 0.0D ELSE x END)")))
    rows = rows.withColumn("h1", F.xxhash64("label", "v")).withColumn("h2", F.hash("v", "label"))
    groups = rows.where("ok").groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies"), F.first("v").alias("v"))
    groups = scratch.keep(groups, "classes")
    largest, d = groups.groupBy("label", F.size("v").alias("d")).agg(F.count("*").alias("n")).agg(F.max("n"), F.max("d")).first()
    if not d:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    bits, bands = bands_of(largest, threshold, miss)

    def code(batches):
        for batch in batches:
            v, sizes = batch.column("v"), np.array([len(x) for x in batch.column("v")])
            for d in np.unique(sizes).tolist():
                at = pa.array(np.flatnonzero(sizes == d))
                x, _ = _units(v.take(at))
                codes, f = zip(*(encode(x, rotation(d, -1 - t)) for t in range(TURNS)))
                keys = np.zeros((len(x), bands), np.uint64)
                per = max(1, d // bits)
                signs = None
                for b in range(bands):
                    if d >= bits:
                        if b % per == 0:
                            signs = x @ rotation(d, 1 + b // per) >= 0
                        part = signs[:, (b % per) * bits : (b % per + 1) * bits]
                    else:
                        part = np.concatenate([x @ rotation(d, 1 + b * (bits // d + 1) + j) >= 0 for j in range(bits // d + 1)], axis=1)[:, :bits]
                    keys[:, b] = mix((part @ (1 << np.arange(bits, dtype=np.uint64))).astype(np.uint64) * np.uint64(1 << 16) ^ constants(1, 1000 + b + d * 65536)[0])
                yield pa.RecordBatch.from_arrays([batch.column("rep").take(at), batch.column("label").take(at).cast(pa.string()), pa.array(list(np.concatenate(codes, axis=1)), pa.list_(pa.int64())), pa.array(list(np.stack(f, axis=1)), pa.list_(pa.float64())), pa.array(list(keys.view(np.int64)), pa.list_(pa.int64()))], ["rep", "label", "code", "f", "keys"])

    codes = scratch.keep(groups.select("rep", "label", "v").mapInArrow(code, "rep long, label string, code array<long>, f array<double>, keys array<long>"), "codes")
    index = codes.select("rep", "code", "label", "keys", F.posexplode("keys").alias("band", "own"))
    before = [F.get("keys", F.col("band") - i).alias(f"k{i}") for i in range(1, LOOK_BACK + 1)]
    index = index.select(F.xxhash64("own", "label").alias("key"), "rep", "code", *before)
    shared = index.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high").select("key")
    index = scratch.keep(index.join(shared, "key"), "bands")
    p, most_bits = math.acos(threshold) / math.pi, TURNS * d
    most = math.floor(most_bits * p + sigmas * math.sqrt(most_bits * p * (1 - p)))
    words = TURNS * -(-d // 64)
    differ = sum((F.coalesce(F.bit_count(F.get("ca", F.lit(i)).bitwiseXOR(F.get("cb", F.lit(i)))), F.lit(0)) for i in range(words)), F.lit(0))
    a, b = (index.select("key", F.col("rep").alias(x), F.col("code").alias(f"c{x}"), *[F.col(f"k{i}").alias(f"{x}{i}") for i in range(1, LOOK_BACK + 1)]) for x in "ab")
    # a pair that meets in several bands stands in the first; bands shortly after another shared one are passed over
    fresh = F.expr(" AND ".join(f"coalesce(a{i} <> b{i}, true)" for i in range(1, LOOK_BACK + 1)))
    pairs = a.join(b, "key").where("a < b").where(fresh).where(F.size("ca") == F.size("cb")).where(differ <= most).select("a", "b").distinct()
    pairs = scratch.keep(pairs, "candidates")

    def bounds(batches):
        """Of pairs with the code of a and the vector of b, those whose upper bound reaches the threshold."""
        for batch in batches:
            vb, sizes = batch.column("vb"), np.array([len(x) for x in batch.column("vb")])
            keep = np.zeros(batch.num_rows, bool)
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                q, _ = _units(vb.take(pa.array(at)))
                code, f = (np.stack(batch.column(c).take(pa.array(at)).to_numpy(zero_copy_only=False)) for c in ("code", "f"))
                wide = -(-d // 64)
                value, width = np.zeros(len(at)), np.zeros(len(at))
                for t in range(TURNS):
                    own = np.ascontiguousarray(code[:, t * wide : (t + 1) * wide]).astype(np.int64)
                    signs = np.unpackbits(own.view(np.uint8), axis=1, bitorder="little")[:, :d].astype(np.float64) * 2 - 1
                    inner, error = estimate(signs, f[:, t], q, rotation(d, -1 - t))
                    value, width = value + inner / TURNS, width + (error * sigmas / SIGMAS / TURNS) ** 2
                keep[at] = value + np.sqrt(width) >= threshold
            yield batch.select(["a", "b", "vb"]).filter(pa.array(keep))

    def exact(batches):
        for batch in batches:
            va, vb = batch.column("va"), batch.column("vb")
            sizes = np.array([len(x) for x in va])
            keep = np.zeros(batch.num_rows, bool)
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                x, y = (np.stack(v.take(pa.array(at)).to_numpy(zero_copy_only=False)).astype(np.float64) for v in (va, vb))
                x, y = x / np.abs(x).max(1, keepdims=True), y / np.abs(y).max(1, keepdims=True)
                keep[at] = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1)) >= threshold
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    # codes and one vector decide which pairs need the other vector
    near_by = pairs.join(codes.select(F.col("rep").alias("a"), "code", "f"), "a").join(groups.select(F.col("rep").alias("b"), F.col("label").alias("lb"), F.col("v").alias("vb")), "b")
    unsure = near_by.select("a", "b", "code", "f", "vb").mapInArrow(bounds, "a long, b long, vb array<double>")
    full = groups.select(F.col("rep").alias("a"), F.col("label").alias("la"), F.col("v").alias("va"))
    both = unsure.join(full, "a").join(groups.select(F.col("rep").alias("b"), F.col("label").alias("lb")), "b").where("la = lb AND size(va) = size(vb)")
    links = scratch.keep(both.select("a", "b", "va", "vb").mapInArrow(exact, "a long, b long").distinct(), "links")

    size = groups.select(F.col("rep").alias("to"), "copies")
    both = links.select(F.col("a").alias("rep"), F.col("b").alias("to")).unionByName(links.select(F.col("b").alias("rep"), F.col("a").alias("to")))
    degree = both.join(size, "to").groupBy("rep").agg(F.sum("copies").alias("others"))
    place = rows.where("ok").select("vec_id", "label", "h1", "h2").join(groups.select("label", "h1", "h2", "rep", "copies"), ["label", "h1", "h2"])
    own = place.join(degree, "rep", "left").select("vec_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n"))
    own = own.groupBy("vec_id").agg(F.max("n").alias("n"))
    roots = components(links.unionByName(place.where("rep <> vec_id").select(F.col("rep").alias("a"), F.col("vec_id").alias("b"))), scratch)
    scratch.only(groups, links, roots)
    out = rows.select("vec_id").join(own, "vec_id", "left").join(roots.withColumnsRenamed({"node": "vec_id", "root": "component_id"}), "vec_id", "left")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 0.93)
