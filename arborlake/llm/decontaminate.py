"""Operator 3: removal of benchmark text by exact word windows.

Both sides are lower-cased (A-Z) and cut into words of digits, a-z and non-ASCII
characters. A benchmark item gives every run of ``n`` consecutive words; an item with
fewer words, but not none, gives its whole sequence. The hashes of these windows go to
every task as one sorted array with a bitmap before it; each hash hit is verified on the
words themselves. Documents are scanned once, as read, without a shuffle.

The windows are broadcast only while the benchmark's text is within ``limit`` bytes, which
is measured first. What is sent are arrays: about 60 bytes a word, 10 times the text at six
bytes a word and at most 30 times where every word is a single letter. A larger benchmark is split into groups within
that bound; the documents are scanned with each group in turn and the hits of a document are merged.

Nulls and texts without words have no windows and are never hit; null item ids mark
hits but are not listed; a null doc_id is kept. Repeated items hit alike and are listed once each;
repeated rows of documents have a row each, so ties don't arise. Without items nothing is hit, and
empty documents give no rows. Texts of any length are scanned whole, about a megabyte of text at a
time. Extra columns, whatever their names, stay as they are in ``decontaminate`` and aren't read by ``find``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textvec import Words, mix, slices, windows

BROADCAST_BYTES = 8 << 20
BITMAP = 20
FOUND = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,stop:long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


class Windows:
    """The windows of benchmark items in arrays, by length: sorted hashes, one place of each window in the items' words, and its items.

    With its words, a window takes about 60 bytes, however it is spelled.
    """

    def __init__(self, items: list[tuple[object, str | None]], n: int):
        self.names = [None if i is None else str(i) for i, _ in items]
        self.words = words = Words(pa.array([t for _, t in items], pa.string()))
        self.by_length: dict[int, tuple[np.ndarray, ...]] = {}
        item = np.repeat(np.arange(len(items)), words.counts)
        sizes = np.minimum(n, words.counts)
        for size in np.unique(sizes[words.counts > 0]).tolist():
            place = np.arange(max(len(item) - size + 1, 0))
            place = place[(sizes[item[place]] == size) & (place + size <= words.first[item[place] + 1])]
            h, second = windows(words.hash, size)[place], windows(mix(words.hash), size)[place]
            order = np.lexsort((place, second, h))
            h, second, place = h[order], second[order], place[order]
            new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (second[1:] != second[:-1]))))
            bitmap = np.zeros(1 << BITMAP, bool)
            bitmap[h[new] >> np.uint64(64 - BITMAP)] = True
            self.by_length[size] = bitmap, h[new], place[new], np.append(new, len(h)), item[place].astype(np.int32)
        words.hash = words.begin = words.stop = None  # not needed to verify

    def scan(self, words: Words) -> tuple[np.ndarray, list[set[str]]]:
        """Flags of hit words, and the items found in each text."""
        total = len(words.hash)
        depth = np.zeros(total + 1, np.int32)
        doc = np.repeat(np.arange(len(words.counts)), words.counts)
        items: list[set[str]] = [set() for _ in words.counts]
        for size, (bitmap, values, place, first, member) in self.by_length.items():
            h = windows(words.hash, size)
            maybe = np.flatnonzero(bitmap[h >> np.uint64(64 - BITMAP)])
            maybe = maybe[maybe + size <= words.first[doc[maybe] + 1]]
            at = np.searchsorted(values, h[maybe])
            same = values[np.minimum(at, len(values) - 1)] == h[maybe]
            for i, k in zip(maybe[same].tolist(), at[same].tolist()):
                own = spelled(words, i, size)
                while k < len(values) and values[k] == h[i]:
                    if spelled(self.words, int(place[k]), size) == own:
                        depth[i] += 1
                        depth[i + size] -= 1
                        items[doc[i]].update(x for m in member[first[k] : first[k + 1]] if (x := self.names[m]) is not None)
                        break
                    k += 1
        return np.cumsum(depth[:total]) > 0, items


def spelled(words: Words, first: int, size: int) -> bytes:
    return b" ".join(words.text(i).lower() for i in range(first, first + size))


def hit_spans(words: Words, hit: np.ndarray, i: int) -> list[dict[str, int]]:
    """Byte ranges, within text i, of its runs of hit words."""
    a, b = words.first[i], words.first[i + 1]
    edge = np.flatnonzero(np.diff(hit[a:b].view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    begin = words.begin[i]
    return [{"start": int(words.start[a + s] - begin), "stop": int(words.end[a + e - 1] - begin)} for s, e in zip(edge[::2], edge[1::2])]


def without(text: str | None, spans: list) -> str | None:
    """The text without the given byte ranges."""
    if text is None or not spans:
        return text
    raw, out, at = text.encode(), [], 0
    for s in spans:
        out.append(raw[at : s["start"]])
        at = s["stop"]
    return b"".join([*out, raw[at:]]).decode()


def item_groups(benchmark: DataFrame, item: str = "item_id", text: str = "text", limit: int = BROADCAST_BYTES) -> list[DataFrame]:
    """The benchmark's distinct items in parts whose texts are within ``limit`` bytes each, which is checked (a single item may exceed it by its own length)."""
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total <= limit:
        return [rows]
    rows, n = rows.distinct(), -(-3 * total // (2 * limit))
    part = lambda n: F.pmod(F.xxhash64("item", "text"), F.lit(n))
    while not rows.groupBy(part(n)).agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).where((F.col("bytes") > limit) & (F.col("n") > 1)).isEmpty():
        n *= 2
    return [rows.where(part(n) == k) for k in range(n)]


def _windows_of(group: DataFrame, n: int) -> Windows:
    return Windows([(r["item"], r["text"]) for r in group.collect()], n)


def find(docs: DataFrame, benchmark: DataFrame, n: int = 10, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Per row of ``docs``: words, hit words, items found and the byte ranges of hit words."""
    groups = item_groups(benchmark, limit=limit)
    if len(groups) > 1:
        return _merged(docs, groups, n)
    held = docs.sparkSession.sparkContext.broadcast(_windows_of(groups[0], n))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            words = Words(batch.column(1))
            hit, items = held.value.scan(words)
            hits = np.concatenate(([0], np.cumsum(hit)))[words.first]
            spans = [hit_spans(words, hit, i) if hits[i + 1] > hits[i] else [] for i in range(batch.num_rows)]
            columns = [batch.column(0), pa.array(words.counts), pa.array(np.diff(hits)), pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(spans, _SPANS)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_hit", "items", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(scan, FOUND)


def _numbered(docs: DataFrame, columns: list) -> DataFrame:
    from .scratch import Scratch

    return Scratch(docs.sparkSession, "decontaminate").keep(docs.select(*columns, F.monotonically_increasing_id().alias("__row")), "rows")


def _runs(rows: DataFrame, groups: list[DataFrame], n: int) -> DataFrame:
    """(__row, items, runs) of the rows (text, __row) that are hit: their runs of hit words, from one scan a group.

    The scans run one after the other and leave tables of hits, so driver and workers hold the windows of one group at a time.
    """
    from .scratch import Scratch

    scratch, found = Scratch(rows.sparkSession, "decontaminate"), None
    for group in groups:
        held = rows.sparkSession.sparkContext.broadcast(_windows_of(group, n))

        def scan(batches, held=held):
            for batch in slices(batches, 0):
                words = Words(batch.column(0))
                hit, items = held.value.scan(words)
                hits = np.concatenate(([0], np.cumsum(hit)))[words.first]
                own = np.flatnonzero(np.diff(hits))
                runs = []
                for i in own.tolist():
                    a = words.first[i]
                    edge = np.flatnonzero(np.diff(hit[a : words.first[i + 1]].view(np.int8), prepend=np.int8(0), append=np.int8(0)))
                    runs.append([{"start": int(s), "stop": int(e)} for s, e in zip(edge[::2], edge[1::2])])
                yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(own)), pa.array([sorted(items[i]) for i in own], pa.list_(pa.string())), pa.array(runs, _SPANS)], ["__row", "items", "runs"])

        part = rows.select(F.col("text").cast("string"), "__row").mapInArrow(scan, "__row long, items array<string>, runs array<struct<start:long,stop:long>>")
        part = scratch.keep(part, "hits")
        held.destroy()
        found = part if found is None else found.unionByName(part)
    return found.groupBy("__row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("runs")).alias("runs"))


def _marked(words: Words, runs: list) -> np.ndarray:
    """Flags of the words in the runs of each text."""
    hit = np.zeros(len(words.hash), bool)
    for i, own in enumerate(runs):
        for r in own or []:
            hit[words.first[i] + r["start"] : words.first[i] + r["stop"]] = True
    return hit


def _merged(docs: DataFrame, groups: list[DataFrame], n: int) -> DataFrame:
    """Several scans: a document's hit words are those in the union of its spans."""
    rows = _numbered(docs, [F.col("doc_id").cast("long"), F.col("text").cast("string")])
    found = _runs(rows, groups, n)

    def finish(batches):
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            hit = _marked(words, batch.column("runs").to_pylist())
            hits = np.concatenate(([0], np.cumsum(hit)))[words.first]
            items = pa.array([x or [] for x in batch.column("items").to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words.counts), pa.array(np.diff(hits)), items, pa.array([hit_spans(words, hit, i) for i in range(batch.num_rows)], _SPANS)], ["doc_id", "n_words", "n_hit", "items", "spans"])

    return rows.join(found, "__row", "left").select("doc_id", "text", "items", "runs").mapInArrow(finish, FOUND)


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "document", limit: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with all its columns, without hit documents or (``remove="span"``) without their hit spans."""
    if remove not in ("document", "span"):
        raise ValueError("remove is 'document' or 'span'")
    place, groups = docs.columns.index("text"), item_groups(benchmark, limit=limit)

    def cut(batch: pa.RecordBatch, words: Words, hit: np.ndarray, hits: np.ndarray) -> pa.RecordBatch:
        texts = [without(t, hit_spans(words, hit, i)) if hits[i] else t for i, t in enumerate(batch.column(place).to_pylist())]
        return pa.RecordBatch.from_arrays([*batch.columns[:place], pa.array(texts, batch.schema.field(place).type), *batch.columns[place + 1 :]], schema=batch.schema)

    if len(groups) > 1:
        rows = _numbered(docs, ["*"])
        found = _runs(rows, groups, n).select("__row", F.col("runs").alias("__runs"))
        if remove == "document":
            return rows.join(found, "__row", "left_anti").select(docs.columns)

        def spans(batches):
            for batch in slices(batches, place):
                words = Words(batch.column(place))
                hit = _marked(words, batch.column("__runs").to_pylist())
                kept = batch.select(docs_columns)
                yield cut(kept, words, hit, np.diff(np.concatenate(([0], np.cumsum(hit)))[words.first]))

        docs_columns = docs.columns
        return rows.join(found, "__row", "left").select(*docs_columns, "__runs").mapInArrow(spans, docs.schema)
    held = docs.sparkSession.sparkContext.broadcast(_windows_of(groups[0], n))

    def clean(batches):
        for batch in slices(batches, place):
            words = Words(batch.column(place))
            hit, _ = held.value.scan(words)
            hits = np.diff(np.concatenate(([0], np.cumsum(hit)))[words.first])
            if remove == "document":
                yield batch.filter(pa.array(hits == 0))
            else:
                yield cut(batch, words, hit, hits) if hits.any() else batch

    return docs.mapInArrow(clean, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
