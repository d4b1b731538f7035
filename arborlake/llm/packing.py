"""Operator 13: best-fit packing of documents into sequences, by sums of squares.

``cut`` encodes whole texts and cuts what is longer than ``size`` tokens: every piece but the
first is ``size`` long. A full piece is a sequence of its own. ``place`` deals the others at random
into groups of about ``group`` pieces; a task packs its group, longest first. With N(g) open sequences
of gap g, a piece of length s goes to the gap g >= s for which the sum of squares of the counts becomes
smallest, which is where 2 (N(g - s) - N(g) + 1), or 1 - 2 N(s) if it fills the sequence, is least; of equal ones
to the smallest gap. A new sequence is begun only where none fits. What a task holds is the
counts and one number an open sequence.

Longest first and no new sequence while one fits are what the rule leaves open, and what few sequences need: over the
lengths of sf0.1 the sequences are 1.0002 times the least possible number, in order of arrival 1.04 times, and
1.01 times if the rule may begin a sequence wherever that has the least squares.

Only row numbers and lengths are shuffled to be packed. ``place`` then joins the places with its pieces and whatever columns
they have, so a caller that needs only lengths or digests drops ``ids`` first. ``sequences`` gives whole sequences.

Nulls: a null text is empty, so its one piece is the end id; a null doc_id is kept. Repeated rows
have their pieces each; pieces of equal length tie and go by their row number. Texts of any length are encoded whole. An
empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .token_output import GROUP_CHARS, width_of
from .tokenize import default_vocabulary, encoder

SIZE, END, GROUP = 1024, 2, 1 << 14
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
#: Pieces in one Arrow batch.
_BATCH = 4096


def bounds(n: int, size: int) -> list[int]:
    """Where a document of ``n`` tokens is cut, ends included; only the first piece may be shorter than ``size``."""
    first = (n - 1) % size + 1
    return [0, *range(first, n + 1, size)]


def cut(docs: DataFrame, vocabulary: str | None = None, end_id: int = END, size: int = SIZE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(row, doc_id, piece, start, length, ids) with ids as little-endian unsigned 32-bit integers; written, so that row numbers stay."""
    vocabulary = vocabulary or default_vocabulary()
    width = width_of(vocabulary, end_id)

    def pieces(batches):
        code, held = encoder(vocabulary, f"<u{width}"), []
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            keys, texts, at = batch.column(0).to_pylist(), batch.column(1), 0
            while at < len(keys):
                upto, chars = at, 0
                while upto < len(keys) and (upto == at or chars < GROUP_CHARS):
                    chars += len(texts[upto].as_buffer()) if texts[upto].is_valid else 0
                    upto += 1
                for doc, parts in zip(keys[at:upto], code.encode_all(texts.slice(at, upto - at).to_pylist()), strict=True):
                    ids = np.frombuffer(b"".join(parts), f"<u{width}").astype("<u4").tobytes() + end
                    edge = bounds(len(ids) // 4, size)
                    for i, (a, b) in enumerate(zip(edge, edge[1:])):
                        held.append((doc, i, a, b - a, ids[4 * a : 4 * b]))
                        if len(held) == _BATCH:
                            yield _batch(held)
                            held = []
                at = upto
        if held:
            yield _batch(held)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = rows.mapInArrow(pieces, "doc_id long, piece int, start long, length long, ids binary")
    return Scratch(docs.sparkSession, "packing").keep(found.select(F.monotonically_increasing_id().alias("row"), "*"), "pieces")


def _batch(held: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _PIECES)], schema=_PIECES)


class Packer:
    """Open sequences by gap, and the sum-of-squares rule."""

    def __init__(self, size: int):
        self.size, self.begun = size, 0
        self.open: list[list[int]] = [[] for _ in range(size)]
        self.count = np.zeros(size + 1, np.int64)

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece of ``length`` tokens."""
        size, count = self.size, self.count
        fits = count[length:size]
        if length < size and fits.any():
            change = 2 * (count[: size - length] - fits + 1)
            change[0] -= 1  # a full sequence is no longer open
            change[fits == 0] = np.iinfo(np.int64).max
            gap = length + int(change.argmin())
            k = self.open[gap].pop()
            count[gap] -= 1
        else:
            gap, k = size, self.begun
            self.begun += 1
        if left := gap - length:
            self.open[left].append(k)
            count[left] += 1
        return k, size - gap


def place(pieces: DataFrame, size: int = SIZE, group: int = GROUP) -> DataFrame:
    """``pieces`` (row, length, and any other columns) with sequence_id and offset. Full pieces have negative ids, packed ones the number of their task in the upper bits."""
    short = pieces.where(F.col("length") < size).select("row", "length")
    tasks = max(1, -(-short.count() // group))

    def pack(batches):
        from pyspark import TaskContext

        base, packer = TaskContext.get().partitionId() << 40, Packer(size)
        for batch in batches:
            placed = [packer.place(n) for n in batch.column(1).to_pylist()]
            ids, offsets = zip(*placed) if placed else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(ids, np.int64) + base), pa.array(offsets, pa.int64())], ["row", "sequence_id", "offset"])

    places = short.repartition(tasks, "row").sortWithinPartitions(F.desc("length"), "row").mapInArrow(pack, "row long, sequence_id long, offset long")
    out = pieces.join(places, "row", "left")
    return out.withColumn("sequence_id", F.coalesce("sequence_id", -1 - F.col("row"))).withColumn("offset", F.coalesce("offset", F.lit(0).cast("long")))


def sequences(placed: DataFrame) -> DataFrame:
    """One row a sequence: its ids and, in order, the (doc_id, piece, offset, length) in it. A group is at most ``size`` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    held = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return held.select("sequence_id", ids.alias("ids"), F.transform("parts", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"], p["length"])).alias("documents"))


def pack(docs: DataFrame, vocabulary: str | None = None, end_id: int = END, size: int = SIZE, group: int = GROUP) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids, sequence_id, offset."""
    return place(cut(docs, vocabulary, end_id, size), size, group).drop("row")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = cut(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
