"""Operator 2: removal of repeated lines, exact or within one edit, by a deletion-neighbourhood join.

Two lines are within one edit (a character inserted, deleted or replaced) exactly when
either a line equals the other less one character, or both are equal after the character
at one place is deleted. So each line gives the hash of itself and of each of its
variants, a character less; lines that meet at a hash are linked where one of them is the
whole line, or where both lack the character at the same place. Of each such meeting only
the earliest line matters: a line is removed when some linked line stands earlier, and
the edit distance of this pair is verified on the texts. Pairs are linear in the rows.

Equal lines are collapsed first. Variants are made only where they can match: of two
lines within one edit, the longer of N characters, either the first N // 2 or the last
N - N // 2 characters are equal. Lines that share neither half with another line have no
partner, and of the others only the half that isn't shared gives variants. This loses
nothing.

"Earliest" is by doc_id, then by the line's place; lines that tie in both, of repeated rows,
are equally early, and neither removes the other. Removal is decided against all lines, also those that
are removed themselves. Lines of under ``least`` characters, without the blanks around them,
always stay. Lines are compared without blanks (space, tab, vertical tab, form feed,
carriage return) around them. ``edits`` is 1, or 0 for exact copies only.

Nulls: a null text has no lines and stays null; a null doc_id is later than all others, and
all null ones tie. An empty text or table stays as it is. Texts and lines may be of any length:
a line of n characters gives up to n variants. Extra columns are not read by ``decide`` and
kept by ``remove_lines``; only names that begin with two underscores are taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .textvec import constants, mix

LEAST = 10
BLANK = " \t\x0b\x0c\r"  # white space around a line that doesn't count
LATE = (1 << 63) - 1
_base = constants(1, 21)[0]


def _h(data: bytes, seed: int) -> int:
    n = xxhash.xxh64_intdigest(data, seed)
    return n - (1 << 64) if n >> 63 else n


def halves(line: str) -> list[int]:
    """Keys of the halves: for the longer line's length N = n and N = n + 1, the first and the last part."""
    n, out = len(line), []
    for big in (n, n + 1):
        cut = big // 2
        for side, part in ((0, line[:cut]), (1, line[n - (big - cut) :] if n >= big - cut else line)):
            out.append(_h(part.encode(), big * 2 + side))
    return out


def powers(n: int) -> np.ndarray:
    out = np.full(n, _base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def variants(line: str, sides: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the line (place -1) and of the line without the character at each place of the halves in ``sides`` (1: last, 2: first)."""
    codes = mix(np.frombuffer(line.encode("utf-32-le"), "<u4").astype(np.uint64)) | np.uint64(1)
    n = len(codes)
    power = powers(n + 1)
    left = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * power[:n], dtype=np.uint64)))  # of the first i characters
    whole = left[n]
    # without character i, those behind it move up by one place
    back = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes[1:] * power[: n - 1], dtype=np.uint64)))  # characters 1.. moved up
    lack = left[:n] + (back[n - 1] - back[:n])
    cut_low, cut_high = n // 2, (n + 1) // 2
    place = np.arange(n)
    keep = ((sides & 1 > 0) & (place >= cut_low - 1)) | ((sides & 2 > 0) & (place <= cut_high))
    hashes = np.concatenate((mix(np.array([whole], np.uint64) + np.uint64(n)), mix(lack[keep] + np.uint64(n - 1))))
    return hashes.view(np.int64), np.concatenate(([-1], place[keep])).astype(np.int32)


def within_one(a: str, b: str) -> bool:
    """Edit distance of at most 1."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def _lines(text: str | None, least: int) -> list[tuple[int, str]]:
    return [(i, s) for i, x in enumerate(text.split("\n")) if len(s := x.strip(BLANK)) >= least] if text else []


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text): null ids come last."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LATE)).alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text"))


def _wanted(docs: DataFrame, lines: DataFrame, *columns: str) -> DataFrame:
    """(doc_id, text, wanted): one of the rows of each doc_id and text in ``lines``, with its wanted lines, at most those it has."""
    key = ["doc_id", "text_hash"]
    wanted = lines.groupBy(*key).agg(F.collect_set(F.struct("line", *columns)).alias("wanted"))
    return _keyed(docs).join(wanted, key).groupBy(*key).agg(F.first("text").alias("text"), F.first("wanted").alias("wanted"))


OCCURS = "doc_id long, text_hash long, line int, h1 long, h2 long, halves array<long>"


def occurrences(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Every line that counts: its document, place, 128-bit hash and the keys of its halves."""

    def run(batches):
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        names = ["doc_id", "text_hash", "line", "h1", "h2", "halves"]
        for batch in batches:
            out = []
            for doc, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                for i, s in _lines(text.as_py(), least):
                    raw = s.encode()
                    out.append((doc, tag, i, _h(raw, 1), _h(raw, 2), halves(s)))
                    if len(out) == 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return _keyed(docs).mapInArrow(run, OCCURS)


def _neighbours(docs: DataFrame, active: DataFrame) -> DataFrame:
    """(hash, place, doc_id, text_hash, line): variants of the lines in ``active`` (doc_id, text_hash, line, sides), each read from its document."""
    names = ["hash", "place", "doc_id", "text_hash", "line"]

    def run(batches):
        for batch in batches:
            held, size = [], 0
            for doc, tag, text, lines in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                parts = (text.as_py() or "").split("\n")
                for w in lines.as_py():
                    h, p = variants(parts[w["line"]].strip(BLANK), w["sides"])
                    held.append((h, p, np.full(len(h), doc), np.full(len(h), tag), np.full(len(h), w["line"], np.int32)))
                    size += len(h)
                    if size >= 1 << 16:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)
                        held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)

    return _wanted(docs, active, "sides").select("doc_id", "text_hash", "text", "wanted").mapInArrow(run, "hash long, place int, doc_id long, text_hash long, line int")


def _texts(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line, s) of given first occurrences (doc_id, text_hash, line)."""

    def run(batches):
        for batch in batches:
            out = []
            for doc, tag, text, lines in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                parts = (text.as_py() or "").split("\n")
                out += [(doc, tag, w["line"], parts[w["line"]].strip(BLANK)) for w in lines.as_py()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int64(), pa.int64(), pa.int32(), pa.string()])], ["doc_id", "text_hash", "line", "s"])

    return _wanted(docs, lines).select("doc_id", "text_hash", "text", "wanted").mapInArrow(run, "doc_id long, text_hash long, line int, s string")


def decide(docs: DataFrame, least: int = LEAST, edits: int = 1) -> DataFrame:
    """(doc_id, text_hash, lines, removed): per doc_id and text, how many lines count and the places of those to remove."""
    if edits not in (0, 1):
        raise ValueError("the bound is 0 or 1 edits")
    scratch = Scratch(docs.sparkSession, "line-dedup")
    found = scratch.keep(occurrences(docs, least), "lines")
    # the first occurrence of a line; the text's hash tells rows of one doc_id apart and decides nothing
    at = F.struct("doc_id", "line", "text_hash")
    classes = found.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.first("halves").alias("halves"))
    key = ["doc_id", "text_hash", "line"]
    classes = scratch.keep(classes.select("h1", "h2", *[F.col(f"first.{c}").alias(c) for c in key], "halves"), "classes")
    heads = classes.withColumn("gone", F.lit(False))
    if edits:
        gone = _gone(docs, classes, scratch).withColumn("gone", F.lit(True))
        heads = classes.join(gone, key, "left").withColumn("gone", F.coalesce("gone", F.lit(False)))
    heads = heads.select("h1", "h2", F.struct("doc_id", "line").alias("first"), "gone")
    each = found.select("doc_id", "text_hash", "line", "h1", "h2").join(heads, ["h1", "h2"])
    drop = F.col("gone") | (F.struct("doc_id", "line") > F.col("first"))
    out = each.groupBy("doc_id", "text_hash").agg(F.collect_set(F.when(drop, F.col("line"))).alias("removed"), F.count_distinct("line").cast("long").alias("lines"))
    out = scratch.keep(out, "decided")
    scratch.drop(found, classes)
    return out


def _gone(docs: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text_hash, line) of the classes with an earlier line within one edit."""
    key = ["doc_id", "text_hash", "line"]
    at = F.struct("doc_id", "line", "text_hash")
    keys = classes.select(*key, F.posexplode("halves").alias("side", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    # a shared first half (side 0) leaves edits to the last one, and the other way round
    active = keys.join(shared, "key").groupBy(*key).agg(F.bit_or(F.when(F.col("side") % 2 == 0, 1).otherwise(2)).alias("sides"))
    # one shuffle of the variants serves both sides of this join; few hashes are met twice
    every = scratch.keep(_neighbours(docs, active), "variants")
    near = every.repartition("hash")
    twice = near.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    near = scratch.keep(near.join(twice, "hash"), "met")
    place = near.groupBy("hash", "place").agg(F.min(at).alias("low"))
    # of a hash: the whole line, if there is one, the earliest line less a character, and by place
    meet = near.groupBy("hash").agg(F.min(F.when(F.col("place") < 0, at)).alias("whole"), F.min(F.when(F.col("place") >= 0, at)).alias("less"))
    met = near.join(meet, "hash").join(place, ["hash", "place"])
    earlier = F.when(F.col("place") < 0, F.col("less")).otherwise(F.least("low", F.col("whole")))
    pairs = met.select(*key, earlier.alias("to")).where(F.struct("to.doc_id", "to.line") < F.struct("doc_id", "line")).groupBy(*key).agg(F.min("to").alias("to"))
    pairs = scratch.keep(pairs.select(*key, *[F.col(f"to.{c}").alias(f"to_{c}") for c in key]), "pairs")
    both = pairs.select(*key).unionByName(pairs.select(*[F.col(f"to_{c}").alias(c) for c in key]))
    texts = scratch.keep(_texts(docs, both), "texts")
    a, b = texts.withColumnRenamed("s", "a"), texts.select(*[F.col(c).alias(f"to_{c}") for c in key], F.col("s").alias("b"))

    def verify(batches):
        for batch in batches:
            good = [within_one(x, y) for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())]
            yield batch.select(key).filter(pa.array(good, pa.bool_()))

    gone = pairs.join(a, key).join(b, [f"to_{c}" for c in key]).select(*key, "a", "b").mapInArrow(verify, "doc_id long, text_hash long, line int").distinct()
    gone = scratch.keep(gone, "gone")
    scratch.drop(every, near, pairs, texts)
    return gone


def remove_lines(docs: DataFrame, least: int = LEAST, edits: int = 1) -> DataFrame:
    """``docs`` with all its columns and the repeated lines taken out of the texts; two columns follow, __lines and __removed."""
    held = decide(docs, least, edits).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("lines").alias("__lines"), F.col("removed").alias("__drop"))
    left = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(LATE)), "__hash": F.xxhash64(F.col("text").cast("string"))})
    out = left.join(held, ["__id", "__hash"], "left")
    parts = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains(F.coalesce("__drop", F.array().cast("array<int>")), i))
    text = F.when(F.coalesce(F.size("__drop"), F.lit(0)) > 0, F.array_join(parts, "\n")).otherwise(F.col("text"))
    return out.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns], F.coalesce("__lines", F.lit(0)).alias("__lines"), F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("__removed"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), F.length("text").cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256"))
