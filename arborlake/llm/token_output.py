"""Operator 1: token ids in seekable zstandard shards.

A shard holds whole documents in ascending id order, one independent zstandard
frame a document (more for documents of over ``FRAME_IDS`` ids). Three skippable
frames follow, so any zstandard decoder still reads the plain stream of ids:

* the directory: per document its id (or null) and its number of frames,
* the seek table of the public seekable format: compressed size, decompressed size
  and the low 32 bits of the content's XXH64 for each frame, then its footer.

Ids are little-endian, 16 bits wide where the vocabulary fits and 32 otherwise; the
manifest names the width. Files appear under their final name only when complete, and
writing a shard again gives the same bytes, so a task may run more than once.

Nulls: a null text counts as empty (only the end id); a null doc_id sorts first.
Repeated ids keep all their rows, ordered by a hash of the text; equal rows tie and stand one
after the other. A text of any length is encoded whole, and has a frame for each ``FRAME_IDS`` ids.
An empty table gives an empty manifest and no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch, delete_matching
from .tokenize import default_vocabulary, encoder

SKIP, FOOTER = 0x184D2A50, 0x8F92EAB1
SEEK = 0x184D2A5E
FRAME_IDS = 1 << 22
#: Documents encoded at once within a task, by characters.
GROUP_CHARS = 1 << 20
MANIFEST = "shard long, path string, width int, n_docs long, n_tokens long, bytes long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long, shard long, n_frames int"


def filesystem(uri: str):
    """A pyarrow file system and path; any scheme that pyarrow knows serves as the shared store."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


class ShardWriter:
    def __init__(self, out, width: int, level: int = 3):
        import zstandard

        self.out, self.width, self.level = out, width, level
        self.pack = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.seek, self.ids, self.frames, self.n_tokens, self.bytes = [], [], [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        import xxhash

        step, n = FRAME_IDS * self.width, 0
        for at in range(0, max(len(ids), 1), step):
            raw = ids[at : at + step]
            packed = self.pack.compress(raw)
            self.out.write(packed)
            self.seek.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.bytes += len(packed)
            n += 1
        self.ids.append(doc_id)
        self.frames.append(n)
        self.n_tokens += len(ids) // self.width

    def close(self) -> None:
        import zstandard

        known = np.array([x is not None for x in self.ids], np.uint8)
        ids = np.array([x or 0 for x in self.ids], "<i8")
        directory = zstandard.ZstdCompressor(level=self.level).compress(struct.pack("<Q", len(ids)) + ids.tobytes() + known.tobytes() + np.array(self.frames, "<u4").tobytes())
        table = np.array(self.seek, "<u4").reshape(-1, 3).tobytes() + struct.pack("<IBI", len(self.seek), 0x80, FOOTER)
        self.out.write(struct.pack("<II", SKIP, len(directory) + 4) + directory + struct.pack("<I", len(directory)))
        self.out.write(struct.pack("<II", SEEK, len(table)) + table)
        self.bytes += len(directory) + len(table) + 20


class ShardReader:
    """Reads the directory and the seek table; then only the frames of requested documents."""

    def __init__(self, source, size: int, width: int):
        import zstandard

        self.source, self.width, self.unpack = source, width, zstandard.ZstdDecompressor()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER or flags != 0x80:
            raise ValueError("no seek table")
        begin = size - 9 - 12 * n
        self.seek = np.frombuffer(self._at(begin, 12 * n), "<u4").reshape(-1, 3)
        (length,) = struct.unpack("<I", self._at(begin - 12, 4))
        raw = self.unpack.decompress(self._at(begin - 12 - length, length))
        (docs,) = struct.unpack("<Q", raw[:8])
        self.ids = np.frombuffer(raw, "<i8", docs, 8)
        self.known = np.frombuffer(raw, np.uint8, docs, 8 + 8 * docs).astype(bool)
        self.frames = np.frombuffer(raw, "<u4", docs, 8 + 9 * docs).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.frames)))
        self.offset = np.concatenate(([0], np.cumsum(self.seek[:, 0], dtype=np.int64)))

    def _at(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def frames_of(self, i: int):
        """The ids of document ``i`` of the shard, frame by frame, each checked against its checksum."""
        import xxhash

        packed = self._at(int(self.offset[self.first[i]]), int(self.offset[self.first[i + 1]] - self.offset[self.first[i]]))
        base = self.offset[self.first[i]]
        for k in range(self.first[i], self.first[i + 1]):
            raw = self.unpack.decompress(packed[self.offset[k] - base : self.offset[k + 1] - base], max_output_size=int(self.seek[k, 1]) or 1)
            if len(raw) != self.seek[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.seek[k, 2]:
                raise ValueError(f"frame {k} is damaged")
            yield np.frombuffer(raw, f"<u{self.width}")

    def find(self, doc_id: int) -> list[int]:
        """Places of a document id; ids ascend, nulls first."""
        nulls = int((~self.known).sum())
        lo, hi = (np.searchsorted(self.ids[nulls:], doc_id, side) for side in ("left", "right"))
        return list(range(nulls + lo, nulls + hi))


def width_of(vocabulary: str, end_id: int) -> int:
    """Bytes that hold every id of the vocabulary: 2 or 4."""
    from tokenizers import Tokenizer

    most = max(end_id, max(Tokenizer.from_file(vocabulary).get_vocab().values(), default=0))
    return 2 if most < 1 << 16 else 4


def write(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = 2, width: int | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode whole texts and write the shards under ``folder``; returns the manifest, a row a shard.

    The one shuffle deals documents by ranges of their id; a shard is a partition's
    documents. Ranges also cut by the hash of the text and then by the row's number, so a
    repeated id, or even a repeated row, may span shards; the order within an id is that of the hash throughout.
    """
    spark, vocabulary = docs.sparkSession, vocabulary or default_vocabulary()
    width = width or width_of(vocabulary, end_id)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    # rows that are equal in both are interchangeable; their number only deals them out
    rows = rows.withColumn("nth", F.pmod(F.monotonically_increasing_id(), F.lit(1 << 12)))
    rows = rows.repartitionByRange("doc_id", "tie", "nth").sortWithinPartitions("doc_id", "tie", "nth")

    def shard(batches):
        from pyspark import TaskContext

        context, out, done = TaskContext.get(), None, False
        k = context.partitionId()
        store, place = filesystem(folder)
        name, temp = f"{place}/part-{k:06d}.zst", f"{place}/_part-{k:06d}-{context.taskAttemptId()}"
        code = encoder(vocabulary, f"<u{width}")
        end = np.array([end_id], f"<u{width}").tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            at = 0
            while at < len(ids):
                upto, chars = at, 0
                while upto < len(ids) and (upto == at or chars < GROUP_CHARS):
                    chars += len(texts[upto].as_buffer()) if texts[upto].is_valid else 0
                    upto += 1
                if out is None:
                    store.create_dir(place, recursive=True)
                    out = store.open_output_stream(temp)
                    writer = ShardWriter(out, width)
                for doc, parts in zip(ids[at:upto], code.encode_all(texts.slice(at, upto - at).to_pylist()), strict=True):
                    writer.add(doc, b"".join(parts) + end)
                at = upto
        if out is not None:
            writer.close()
            out.close()
            store.move(temp, name)
            row = {"shard": [k], "path": [f"part-{k:06d}.zst"], "width": [width], "n_docs": [len(writer.ids)], "n_tokens": [writer.n_tokens], "bytes": [writer.bytes]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("shard", pa.int64()), ("path", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("bytes", pa.int64())]))

    rows.select("doc_id", "text").mapInArrow(shard, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    delete_matching(spark, f"{folder}/_part-*")  # of tasks that were lost
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: its id, the number of ids before it, of its own, and their crc32 as 32-bit integers."""
    shards = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    n = max(1, manifest.count())

    def documents(batches):
        store, place = filesystem(folder)
        kinds = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("shard", pa.int64()), ("n_frames", pa.int32())])
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{place}/{row['path']}") as source:
                    reader = ShardReader(source, source.size(), row["width"])
                    start, held = row["base"], []
                    for i in range(len(reader.ids)):
                        n, crc = 0, 0
                        for ids in reader.frames_of(i):
                            n += len(ids)
                            crc = zlib.crc32(ids.astype("<u4", copy=False).tobytes(), crc)
                        held.append((int(reader.ids[i]) if reader.known[i] else None, start, n, crc, row["shard"], int(reader.frames[i])))
                        start += n
                        if len(held) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), kinds)], schema=kinds)
                            held = []
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), kinds)], schema=kinds)

    return shards.repartition(n).mapInArrow(documents, DOCS)


def fetch(manifest: DataFrame, folder: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of the requested documents; of each shard only the directory and their frames are read."""

    def pick(batches):
        store, place = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{place}/{row['path']}") as source:
                    reader = ShardReader(source, source.size(), row["width"])
                    for doc in doc_ids:
                        for i in reader.find(doc):
                            got = np.concatenate(list(reader.frames_of(i))).astype("int32")
                            yield pa.RecordBatch.from_pydict({"doc_id": pa.array([doc], pa.int64()), "ids": pa.array([got], pa.list_(pa.int32()))})

    return manifest.repartition(max(1, manifest.count())).mapInArrow(pick, "doc_id long, ids array<int>")


def token_output(docs: DataFrame, vocabulary: str | None = None, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write shards and return the digest that reading them back gives. Files in a given ``folder`` stay; without one they go to a folder of the shared store that lasts as long as the driver."""
    folder = folder or Scratch(docs.sparkSession, "token-output").path("shards")
    return read(write(docs, folder, vocabulary, end_id), folder)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(spark.read.parquet(f"{sf_dir}/documents.parquet"))
