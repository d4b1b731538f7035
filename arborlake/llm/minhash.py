"""Operator 9: near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A document is the set of its word shingles; documents are linked when the Jaccard
similarity of their full sets is at least ``percent`` / 100, decided in integers.

1. Documents of equal sets form a class; one row a class goes on, so exact copies cost
   nothing further and lose no link.
2. A class gets ``WIDTH`` MinHash values of 16 bits for each of a number of chunks. Signatures of C chunks
   that differ in at most ``2 * C - 1`` places have, by the pigeonhole principle, a chunk with at most one difference. Each chunk
   therefore gives ``WIDTH`` keys, one with each place left out: such pairs share a key.
3. Candidates are checked on the full sets, in two waves; pairs that are already in one
   component need no check. First every member of a key against its hub, the member that
   shares most keys with others. Then, for keys whose members still are in more than one
   component: of keys of up to ``SMALL`` members all pairs whose components differ, a number
   linear in the rows; of larger keys, everyone outside the largest component against all
   members, in blocks of ``BLOCK`` by ``BLOCK`` within a task (fewer where sets are large), which put out only pairs that
   come near the threshold. A pair that shares several keys is looked at under the first
   one. No candidate is dropped, whatever the size of its key.

The number of chunks and the places in which candidates may differ follow from ``percent`` and ``miss``: a pair
at exactly the threshold shares no key with a probability of ``miss`` at most, and goes beyond those
places with a twentieth of it; closer pairs less often. At 80 and 2e-6 these are 10 chunks and 27 places
of 50, at 50 they are 64 chunks, so lower thresholds have larger signatures and more keys. ``miss`` may be as small as is wanted, but not 0.

The README has the recall measured on planted
pairs. Texts of any length are hashed whole, about a megabyte of text at a time.

Nulls: a null text, or one without words, is an empty set, linked with nothing. To
``links_of``, a null doc_id is linked with nothing and kept, and rows of one doc_id count as
one document, whose links are those of all its rows. To ``keep_first`` each row is a
document, whatever its doc_id. A similarity of exactly the threshold links. Repeated rows have
a row each and are one class. Empty tables give no rows. Extra columns, whatever their names, are
ignored by ``links_of`` and kept by ``keep_first``, except names that begin with two underscores.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .scratch import Scratch
from .textvec import ALNUM, NONSPACE, Words, constants, mix, shingle_sets, slices

WIDTH, SMALL, BLOCK, MISS = 5, 16, 512, 2e-6
#: Shingles of a block's member, on average, that count as one member / columns of a table of shared items.
MEMBER, ITEMS = 4096, 4096


class Index:
    """The signature's chunks and keys for a threshold of ``percent`` and a probability ``miss`` of losing a pair at it."""

    def __init__(self, percent: int = 80, miss: float = MISS):
        if not 0 < percent <= 100 or not 0 < miss < 1:
            raise ValueError("percent is above 0 and at most 100, miss between 0 and 1")
        same, other = percent / 100, 1 - percent / 100
        shared = same**WIDTH + WIDTH * same ** (WIDTH - 1) * other
        self.chunks = max(1, math.ceil(math.log(miss) / math.log1p(-shared))) if shared < 1 else 1
        self.places = n = self.chunks * WIDTH
        self.far, tail = n if other else 0, 0.0  # from all places down, as long as what lies beyond has a small probability
        while self.far:
            log = math.lgamma(n + 1) - math.lgamma(self.far + 1) - math.lgamma(n - self.far + 1)
            tail += math.exp(log + self.far * math.log(other) + (n - self.far) * math.log(same))
            if tail > miss / 20:
                break
            self.far -= 1
        self.xor, self.times = constants(n, 5), constants(n, 6)

    def read(self, values: list[bytes]) -> np.ndarray:
        """Signatures from their bytes, a row each."""
        return np.frombuffer(b"".join(values), "<u2").reshape(-1, self.places)

    def signatures(self, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """16 bits of each MinHash value; empty sets get zeros."""
        out = np.zeros((len(bounds) - 1, self.places), "<u2")
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            for k in range(self.places):
                out[full, k] = np.minimum.reduceat((values ^ self.xor[k]) * self.times[k], bounds[full]) & np.uint64(0xFFFF)
        return out

    def keys(self, sig: np.ndarray) -> np.ndarray:
        """The keys of each signature: for each chunk, one with each place left out."""
        keys = np.empty((len(sig), self.places), np.uint64)
        wide = sig.astype(np.uint64)
        for c in range(self.chunks):
            for m in range(WIDTH):
                h = np.full(len(sig), c * WIDTH + m + 1, np.uint64)
                for j in range(WIDTH):
                    if j != m:
                        h = mix(h * np.uint64(0x10001) + wide[:, c * WIDTH + j])
                keys[:, c * WIDTH + m] = h
        return keys

    def first_shared(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For all pairs of signatures: the number of places that differ, and the first key shared (a number past all keys if none)."""
        differ = x[:, None, :] != y[None, :, :]
        parts = differ.reshape(*differ.shape[:2], self.chunks, WIDTH)
        count = parts.sum(3, dtype=np.int8)
        good = count <= 1
        chunk = good.argmax(2)
        at = np.take_along_axis(parts, chunk[:, :, None, None], 2)[:, :, 0].argmax(2)
        return count.sum(2, dtype=np.int16), np.where(good.any(2), chunk * WIDTH + at, self.places)


def _sets(batch: pa.RecordBatch, flags: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets(Words(batch.column("text"), flags), size)


def _signed(docs: DataFrame, flags: np.ndarray, size: int, how: Index) -> DataFrame:
    """Per row: size of the set, 128 bits that identify it, and its signature."""
    a, b = constants(2, 7)

    def sign(batches):
        for batch in slices(batches, "text"):
            values, bounds = _sets(batch, flags, size)
            total = lambda c, v=values, at=bounds: np.diff(np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(v ^ c), dtype=np.uint64)))[at]).view(np.int64)
            sig = how.signatures(values, bounds)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(total(a)), pa.array(total(b)), pa.array([x.tobytes() for x in sig], pa.binary())], ["doc_id", "n_shingles", "h1", "h2", "sig"])

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, h1 long, h2 long, sig binary")


def _indexed(classes: DataFrame, how: Index) -> DataFrame:
    places = how.places

    def index(batches):
        for batch in batches:
            sig = how.read(batch.column("sig").to_pylist())
            n = batch.num_rows
            keys = pa.array(how.keys(sig).view(np.int64).reshape(-1))
            place = pa.array(np.tile(np.arange(places, dtype=np.int32), n))
            for at in range(0, n * places, 1 << 16):
                yield pa.RecordBatch.from_arrays([keys.slice(at, 1 << 16), pa.array(np.repeat(batch.column("rep").to_numpy(zero_copy_only=False), places)[at : at + (1 << 16)]), place.slice(at, 1 << 16)], ["key", "rep", "place"])

    return classes.select("rep", "sig").mapInArrow(index, "key long, rep long, place int")


class _Join:
    """Candidates, checks and components of one run."""

    def __init__(self, docs: DataFrame, classes: DataFrame, flags: np.ndarray, size: int, percent: int, how: Index, scratch: Scratch):
        self.docs, self.classes, self.flags, self.size, self.percent, self.how, self.scratch = docs, classes, flags, size, percent, how, scratch
        self.links: DataFrame | None = None
        self.tested: DataFrame | None = None
        self.sets: DataFrame | None = None

    def sets_of(self, members: DataFrame) -> None:
        """The full sets of all classes that share a key with another one."""
        flags, size = self.flags, self.size

        def give(batches):
            for part in slices(batches, "text"):
                values, bounds = _sets(part, flags, size)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([values[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary())], ["rep", "items"])

        wanted = members.select(F.col("rep").alias("doc_id")).distinct()
        self.sets = self.scratch.keep(self.docs.join(wanted, "doc_id", "left_semi").mapInArrow(give, "rep long, items binary"), "sets")

    def check(self, pairs: DataFrame) -> None:
        """Check pairs (a, b) of classes, a < b, that weren't checked before; add the links found."""
        pairs = pairs.distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        sig = self.classes.select("rep", "sig")
        pairs = pairs.join(sig.withColumnsRenamed({"rep": "a", "sig": "sa"}), "a").join(sig.withColumnsRenamed({"rep": "b", "sig": "sb"}), "b")

        how = self.how

        def near(batches):
            for batch in batches:
                x, y = (how.read(batch.column(c).to_pylist()) for c in ("sa", "sb"))
                yield batch.select(["a", "b"]).filter(pa.array((x != y).sum(1) <= how.far))

        pairs = self.scratch.keep(pairs.mapInArrow(near, "a long, b long"), "pairs")
        percent = self.percent

        def exact(batches):
            for batch in batches:
                good = []
                for x, y in zip(batch.column("xa"), batch.column("xb")):
                    x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    if len(x) > len(y):
                        x, y = y, x
                    if 100 * len(x) < percent * len(y):
                        good.append(False)
                        continue
                    at = np.searchsorted(y, x)
                    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                    good.append(100 * both >= percent * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

        sets = self.sets
        found = pairs.join(sets.withColumnsRenamed({"rep": "a", "items": "xa"}), "a").join(sets.withColumnsRenamed({"rep": "b", "items": "xb"}), "b")
        found = self.scratch.keep(found.mapInArrow(exact, "a long, b long").distinct(), "links")
        self.links = found if self.links is None else self.links.unionByName(found)
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)

    def placed(self, members: DataFrame) -> DataFrame:
        """Members with the component they are in so far."""
        found = components(self.links, self.scratch)
        return members.join(found.withColumnsRenamed({"node": "rep", "root": "comp"}), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))


def _open(members: DataFrame) -> DataFrame:
    """Members of the keys that hold more than one component, with the key's size."""
    keys = members.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key", "n")
    return members.join(keys, "key")


def _cross(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of members of one key whose components differ."""
    x = left.select("key", F.col("rep").alias("a"), F.col("comp").alias("cx"))
    y = right.select("key", F.col("rep").alias("b"), F.col("comp").alias("cy"))
    return x.join(y, "key").where("a < b AND cx <> cy").select("a", "b")


def _shared_items(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, over the items that occur on both sides, ``ITEMS`` of these at a time."""
    items = np.intersect1d(np.concatenate(x), np.concatenate(y))

    def places(v: np.ndarray) -> np.ndarray:
        at = np.searchsorted(items, v)
        return at[items[np.minimum(at, len(items) - 1)] == v] if len(items) else at[:0]

    def table(sets: list[np.ndarray], low: int) -> np.ndarray:
        out = np.zeros((len(sets), ITEMS), np.float32)
        for i, at in enumerate(sets):
            a, b = np.searchsorted(at, (low, low + ITEMS))
            out[i, at[a:b] - low] = 1
        return out

    x, y = ([places(v) for v in sets] for sets in (x, y))
    both = np.zeros((len(x), len(y)))
    for low in range(0, len(items), ITEMS):
        both += table(x, low) @ table(y, low).T
    return both


def _block_pairs(left: list, right: list, place: int, percent: int, how: Index) -> list[tuple[int, int]]:
    """Pairs of one block, of rows (rep, comp, sig, items), that belong to this key and come within a hundredth of the threshold."""
    sig = [how.read([r[2] for r in rows]) for rows in (left, right)]
    out = []
    step = max(1, 3200 // how.places)
    for at in range(0, len(left), step):
        rows = left[at : at + step]
        distance, owner = how.first_shared(sig[0][at : at + step], sig[1])
        fit = (distance <= how.far) & (owner == place) & (np.array([r[1] for r in rows])[:, None] != np.array([r[1] for r in right])[None])
        i, j = np.flatnonzero(fit.any(1)), np.flatnonzero(fit.any(0))
        if not len(i):
            continue
        x, y = ([np.frombuffer(r[3], np.uint32) for r in part] for part in ([rows[k] for k in i], [right[k] for k in j]))
        both = _shared_items(x, y)
        union = np.array([len(v) for v in x])[:, None] + np.array([len(v) for v in y])[None] - both
        good = fit[np.ix_(i, j)] & (100 * both >= (percent - 1) * union)
        out += [tuple(sorted((rows[i[a]][0], right[j[b]][0]))) for a, b in zip(*np.nonzero(good))]
    return out


def _blocks(many: DataFrame, sets: DataFrame, sig: DataFrame, sizes: DataFrame, percent: int, how: Index) -> DataFrame:
    """Pairs (a, b) of members (key, place, n, rep, comp) of large keys, those outside the key's largest component against all."""
    top = many.join(sizes, "rep").groupBy("key", "comp").agg(F.count("*").alias("c"), (F.sum("n_shingles") / MEMBER).alias("s"))
    first = F.struct("c", "comp")
    top = top.groupBy("key").agg(F.max_by("comp", first).alias("top"), F.greatest(F.sum("c") - F.max("c"), F.sum("s") - F.max_by("s", first)).alias("out"), F.greatest(F.sum("c"), F.sum("s")).alias("all"))
    many = many.join(top, "key")
    cell = F.pmod(F.xxhash64("rep"), F.lit(1 << 30))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    mine = lambda n: (cell % blocks(F.col(n))).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(F.col(n)) - 1))
    outer = many.where("comp <> top").select("key", "place", "rep", "comp", mine("out").alias("x"), every("all").alias("y"), F.lit(0).alias("side"))
    inner = many.select("key", "place", "rep", "comp", every("out").alias("x"), mine("all").alias("y"), F.lit(1).alias("side"))

    def small(batches):
        for batch in batches:
            items = [np.unique(np.frombuffer(v.as_buffer(), np.uint64).astype(np.uint32)).tobytes() for v in batch.column("items")]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(items, pa.binary())], ["rep", "items"])

    brief = sets.join(many.select("rep").distinct(), "rep", "left_semi").mapInArrow(small, "rep long, items binary")
    rows = outer.unionByName(inner).join(sig.join(brief, "rep"), "rep")
    rows = rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "side")

    def compare(batches):
        now, held, place = None, ([], []), 0

        def close():
            pairs = _block_pairs(*held, place, percent, how) if held[0] and held[1] else []
            for at in range(0, len(pairs), 1 << 14):
                a, b = zip(*pairs[at : at + (1 << 14)])
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            names = ("key", "x", "y", "side", "place", "rep", "comp", "sig", "items")
            for key, x, y, side, p, *row in zip(*(batch.column(c).to_pylist() for c in names)):
                if (key, x, y) != now:
                    yield from close()
                    now, held, place = (key, x, y), ([], []), p
                held[side].append(row)
        yield from close()

    return rows.mapInArrow(compare, "a long, b long")


def links_of(docs: DataFrame, words: np.ndarray = ALNUM, size: int = 5, percent: int = 80, small: int = SMALL, miss: float = MISS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable) and kept (component_id = doc_id)."""
    how, scratch = Index(percent, miss), Scratch(docs.sparkSession, "minhash")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = scratch.keep(_signed(docs, words, size, how), "signatures")
    full = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = scratch.keep(full.groupBy("n_shingles", "h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")), "classes")
    run = _Join(docs, classes, words, size, percent, how, scratch)

    index = _indexed(classes, how)
    keys = index.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.count("*").alias("n")).where("low <> high").select("key", "n")
    members = scratch.keep(index.join(keys, "key").dropDuplicates(["key", "rep"]), "members")
    run.sets_of(members)
    weight = members.groupBy("rep").agg(F.sum("n").alias("weight"))
    members = scratch.keep(members.drop("n").join(weight, "rep"), "weighted")
    hubs = members.groupBy("key").agg(F.max_by("rep", F.struct("weight", -F.col("rep"))).alias("hub"))
    run.check(members.join(hubs, "key").where("rep <> hub").select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")))

    left = scratch.keep(_open(run.placed(members.drop("weight"))), "open")
    few = left.where(F.col("n") <= small)
    near = _blocks(left.where(F.col("n") > small), run.sets, classes.select("rep", "sig"), classes.select("rep", "n_shingles"), percent, how)
    run.check(_cross(few, few).unionByName(near))

    # rows of one doc_id but different sets are one document
    same = full.join(classes.select("n_shingles", "h1", "h2", "rep"), ["n_shingles", "h1", "h2"]).select("doc_id", "rep")
    links = run.links.unionByName(same.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    roots = components(links, scratch)
    scratch.only(rows, roots)
    found = roots.withColumnsRenamed({"node": "doc_id", "root": "component_id"})
    out = rows.select("doc_id", "n_shingles").join(found, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with all its columns and one row of each component, the one of the smallest id (null: the last), the first of rows of one id."""
    rows = Scratch(docs.sparkSession, "minhash-rows").keep(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    found = links_of(rows.select(F.col("__row").alias("doc_id"), "text"), **how).where("NOT kept")
    # only rows with links: components of several rows
    linked = found.select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__root"))
    linked = linked.unionByName(linked.select(F.col("__root").alias("__row"), "__root").distinct())
    held = rows.select("__row", F.col("doc_id").cast("long").alias("__id")).join(linked, "__row")
    order = F.struct(F.col("__id").isNull(), "__id", "__row")
    first = held.groupBy("__root").agg(F.min_by("__row", order).alias("__first"))
    gone = held.join(first, "__root").where("__row <> __first").select("__row")
    return rows.join(gone, "__row", "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links_of(spark.read.parquet(f"{sf_dir}/documents.parquet"), NONSPACE, 4, 80)
