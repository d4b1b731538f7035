"""Vectorised word hashing over Arrow string columns, used inside Spark tasks.

Everything works on UTF-8 bytes: the word classes used here are unions of ASCII
sets and "every non-ASCII character", so byte classes and character classes agree.
Texts of any length are handled in pieces of ``PIECE`` bytes that end between words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE, SLICE = 1 << 18, 1 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def slices(batches: Iterable[pa.RecordBatch], text: int | str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in parts of at most ``limit`` bytes of text, or of one row: what a task holds doesn't follow the batch size."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, upto - at)
            at = upto


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers for ``seed``."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def word_class(separators: bytes | None = None) -> np.ndarray:
    """256 flags: which bytes belong to words. None: ASCII letters, digits and all of non-ASCII."""
    flags = np.ones(256, bool)
    if separators is None:
        flags[:128] = [chr(i).isalnum() for i in range(128)]
    else:
        flags[list(separators)] = False
    return flags


#: Words of letters, digits and non-ASCII characters / words between white space.
ALNUM, NONSPACE = word_class(), word_class(b" \t\n\x0b\x0c\r")

_bytes = constants(256, 11)
_bytes[65:91] = _bytes[97:123]  # A-Z count as a-z
_places = constants(64, 12)


def _place(pos: np.ndarray) -> np.ndarray:
    if len(pos) and pos.max() >= 64:
        return np.where(pos < 64, _places[pos & 63], mix(pos.astype(np.uint64)) | np.uint64(1))
    return _places[pos]


def _piece(buf: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of one piece."""
    inside = flags[buf]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, end, np.zeros(0, np.uint64)
    at = np.flatnonzero(inside)
    size = end - start
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    pos = np.arange(len(at)) - np.repeat(first, size)
    return start, end, mix(np.add.reduceat(_bytes[buf[at]] * _place(pos), first))


class Words:
    """The words of a column of texts: hashes, byte ranges within ``data``, and the first word of each text."""

    def __init__(self, column: pa.Array | pa.ChunkedArray, flags: np.ndarray = ALNUM):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = column.cast(pa.large_binary())
        n = len(column)
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
        data = column.buffers()[2] if n else None
        self.data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        lengths = np.diff(offsets)
        if column.null_count:
            lengths = np.where(np.asarray(column.is_valid()), lengths, 0)
        self.begin, self.stop = offsets[:-1], offsets[:-1] + lengths
        starts, ends, hashes, counts = [], [], [], np.zeros(n, np.int64)
        group: list[int] = []
        held = 0
        for i in range(n):
            if lengths[i] > PIECE:
                self._flush(group, starts, ends, hashes, counts, flags)
                group, held = [], 0
                self._long(i, starts, ends, hashes, counts, flags)
            else:
                group.append(i)
                held += lengths[i]
                if held >= PIECE:
                    self._flush(group, starts, ends, hashes, counts, flags)
                    group, held = [], 0
        self._flush(group, starts, ends, hashes, counts, flags)
        cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.start, self.end, self.hash = cat(starts, np.int64), cat(ends, np.int64), cat(hashes, np.uint64)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.counts = counts

    def _flush(self, group, starts, ends, hashes, counts, flags) -> None:
        """Words of several short texts at once; a separator stands between texts."""
        if not group:
            return
        gap = np.full(1, np.flatnonzero(~flags)[0], np.uint8)
        lengths = np.array([self.stop[i] - self.begin[i] for i in group])
        buf = np.concatenate([x for i in group for x in (self.data[self.begin[i] : self.stop[i]], gap)])
        at = np.concatenate(([0], np.cumsum(lengths + 1)))
        s, e, h = _piece(buf, flags)
        which = np.searchsorted(at, s, side="right") - 1
        shift = self.begin[group] - at[:-1]
        starts.append(s + shift[which])
        ends.append(e + shift[which])
        hashes.append(h)
        counts[group] = np.bincount(which, minlength=len(group))

    def _long(self, i, starts, ends, hashes, counts, flags) -> None:
        at, stop = self.begin[i], self.stop[i]
        while at < stop:
            to = min(at + PIECE, stop)
            while to < stop and (inside := flags[self.data[to : to + PIECE]]).all():
                to = min(to + PIECE, stop)
            if to < stop:
                to += int(np.argmin(inside))
            s, e, h = _piece(self.data[at:to], flags)
            starts.append(s + at)
            ends.append(e + at)
            hashes.append(h)
            counts[i] += len(s)
            at = to

    def text(self, i: int, upto: int | None = None) -> bytes:
        """Bytes from word i to word ``upto`` (itself by default)."""
        return self.data[self.start[i] : self.end[i if upto is None else upto]].tobytes()


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of ``n`` consecutive words."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for j, c in enumerate(constants(n, 13)):
        out += hashes[j : j + count] * c
    return mix(out + np.uint64(n))


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, bounds): text i has the sorted distinct shingle hashes ``values[bounds[i]:bounds[i + 1]]``.

    A text of fewer than ``n`` words, but not none, has the whole sequence as its one shingle.
    """
    count = words.counts
    runs = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    bounds = np.concatenate(([0], np.cumsum(runs)))
    doc = np.repeat(np.arange(len(count)), runs)
    values = np.zeros(bounds[-1], np.uint64)
    full = windows(words.hash, n)
    long = count[doc] >= n
    inner = np.arange(bounds[-1]) - bounds[doc]
    values[long] = full[(words.first[doc] + inner)[long]]
    for i in np.flatnonzero((count > 0) & (count < n)):
        values[bounds[i]] = windows(words.hash[words.first[i] : words.first[i + 1]], int(count[i]))[0]
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    if len(values):
        new = np.concatenate(([True], (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])))
        values, doc = values[new], doc[new]
    return values, np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(count)))))
