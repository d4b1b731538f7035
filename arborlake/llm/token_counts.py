"""Operator 10: edit-aware token counts.

A document's text is cut where its vocabulary can't join tokens: before a space that
stands before a character other than white space, and in parts of over ``LONG`` characters also
between pre-tokens (before white space, and between letters, digits and signs of common scripts).
The parts are the leaves of a segment
tree that holds characters and tokens per subtree. An edit replaces a range of
characters: only the leaves it touches, with a leaf or up to ``LONG`` characters of context on either side, are
encoded again; then the sums on the way to the root change. The count always equals
that of encoding the whole edited text. A run of letters, or of digits, is one pre-token, whatever
its length, and so one leaf.

The trees are kept: ``trees_of`` gives a table of texts with the tokens of each leaf, which is
written once; ``applied`` reads it and encodes only what edits touch, and its ``renewed`` table
is what the next edits start from. The sums above the leaves follow from them by additions.

Edits of a document are applied in order of seq, those of one seq by position, length and
replacement; offsets are code points of the text as the edits before left it, and are clipped to its length.

Nulls: a null text is empty; a null position is 0, a null length 0, a null replacement
empty, a null seq comes first; edits of a null doc_id are ignored, and such documents are kept as they are.
Documents without edits keep their count; edits of unknown documents are ignored.
Repeated ids and rows: every row gets the edits of its id. Empty tables give no rows. A text
of any length has one tree, in the memory of one task. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .textvec import slices
from .tokenize import default_vocabulary, encoder

_CUT = re.compile(r" (?=\S)")
#: Parts of more characters than this are cut between pre-tokens.
LONG = 64
_LETTER = "A-Za-z\u0410-\u044f\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
_DIGIT = "0-9"
#: Signs that neither begin a shortened word ("'s") nor stand in the added tokens of vocabularies ("<|end|>", "[MASK]").
_SIGN = "!-&(-.:;=?@^`{}~\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f"
_INNER = re.compile("|".join(rf"(?<=[{x}])(?=[{y}{z}])" for x, y, z in [(_LETTER, _DIGIT, _SIGN), (_DIGIT, _LETTER, _SIGN), (_SIGN, _LETTER, _DIGIT)]) + r"|(?<=\S)(?=[\t\n\r ])")
TREES = "doc_id long, text string, sizes array<int>"
COUNTED = "doc_id long, n_tokens long, n_tokens_after long, n_edits long, n_encoded_chars long, n_chars_after long"

_APPLIED = "doc_id long, tag long, copies long, n_tokens long, n_tokens_after long, n_edits long, n_encoded_chars long, n_chars_after long, text string, sizes array<int>"
_KINDS = pa.schema([*((x.split(" ")[0], pa.int64()) for x in _APPLIED.split(", ")[:8]), ("text", pa.string()), ("sizes", pa.list_(pa.int32()))])


def leaves_of(text: str) -> list[str]:
    """Parts of a text that encode by themselves; they join to the text."""
    parts = _cut(_CUT, text)
    if len(text) <= LONG or max(map(len, parts)) <= LONG:
        return parts
    return [x for p in parts for x in (_cut(_INNER, p) if len(p) > LONG else (p,))]


def _cut(where: re.Pattern, text: str) -> list[str]:
    at = [0, *(m.start() for m in where.finditer(text) if m.start()), len(text)]
    return [text[a:b] for a, b in zip(at, at[1:]) if a < b]


class TokenTree:
    """Leaves under a tree of sums. ``BLOCK`` leaves share a node, so an edit renews one block and the sums above it."""

    BLOCK = 64

    def __init__(self, text: str, count, sizes: list[int] | None = None):
        """``sizes``: tokens of each leaf, if they are known; else all leaves are encoded."""
        self.count = count
        parts = leaves_of(text)
        sizes = count(parts) if sizes is None else sizes
        step = self.BLOCK
        self.blocks = [(parts[i : i + step], sizes[i : i + step]) for i in range(0, len(parts), step)] or [([], [])]
        self._build()
        self.encoded = 0

    def _build(self) -> None:
        """Levels of (characters, tokens), from the blocks to the root."""
        level = np.array([[sum(map(len, p)), sum(s)] for p, s in self.blocks], np.int64)
        self.levels = [level]
        while len(level) > 1:
            level = np.add.reduceat(level, np.arange(0, len(level), 2), axis=0)
            self.levels.append(level)

    @property
    def tokens(self) -> int:
        return int(self.levels[-1][0, 1])

    @property
    def chars(self) -> int:
        return int(self.levels[-1][0, 0])

    @property
    def text(self) -> str:
        return "".join(p for parts, _ in self.blocks for p in parts)

    @property
    def sizes(self) -> list[int]:
        return [n for _, sizes in self.blocks for n in sizes]

    def _find(self, at: int) -> tuple[int, int]:
        """The block that holds character ``at``, and the block's first character."""
        i, before = 0, 0
        for level in reversed(self.levels[:-1]):
            i *= 2
            if i + 1 < len(level) and before + level[i, 0] <= at:
                before += int(level[i, 0])
                i += 1
        return i, before

    def edit(self, at: int, length: int, text: str) -> None:
        at = min(max(at, 0), self.chars)
        stop = min(at + max(length, 0), self.chars)
        a, before = self._find(max(at - 1, 0))
        b, last = self._find(min(stop + 1, max(self.chars - 1, 0)))
        parts = [p for i in range(a, b + 1) for p in self.blocks[i][0]]
        sizes = [s for i in range(a, b + 1) for s in self.blocks[i][1]]
        first, low = 0, before
        while first < len(parts) and low + len(parts[first]) < at:
            low += len(parts[first])
            first += 1
        end, high = first, low
        while end < len(parts) and high <= stop:
            high += len(parts[end])
            end += 1
        # context before, to the start of a space-cut part or over LONG characters, so that joints which the edit undoes are seen and the part is known as long
        start = low
        while (first or a) and not (start == low and at - low > 1 and _CUT.match(parts[first])):
            if not first:
                a -= 1
                parts, sizes = [*self.blocks[a][0], *parts], [*self.blocks[a][1], *sizes]
                first = len(self.blocks[a][0])
                end += first
                continue
            first -= 1
            low -= len(parts[first])
            if start - low > LONG or _CUT.match(parts[first]):
                break
        # context behind, likewise
        while end < len(parts) or b + 1 < len(self.blocks):
            if end == len(parts):
                b += 1
                parts, sizes = [*parts, *self.blocks[b][0]], [*sizes, *self.blocks[b][1]]
                continue
            if high - stop > LONG or high > stop and _CUT.match(parts[end]):
                break
            high += len(parts[end])
            end += 1
        touched = "".join(parts[first:end])
        touched = touched[: at - low] + text + touched[stop - low :]
        new = leaves_of(touched)
        self.encoded += len(touched)
        parts[first:end], sizes[first:end] = new, self.count(new)
        n, k, step = len(parts), b + 1 - a, self.BLOCK
        if n <= 2 * step * k:  # the same blocks, which may hold up to twice as many leaves
            cuts = [n * i // k for i in range(k + 1)]
            self.blocks[a : b + 1] = [(parts[i:j], sizes[i:j]) for i, j in zip(cuts, cuts[1:])]
            for i, (p, c) in enumerate(self.blocks[a : b + 1], a):
                self._renew(i, sum(map(len, p)), sum(c))
        else:
            self.blocks[a : b + 1] = [(parts[i : i + step], sizes[i : i + step]) for i in range(0, n, step)]
            self._build()

    def _renew(self, i: int, chars: int, tokens: int) -> None:
        change = np.array([chars, tokens]) - self.levels[0][i]
        for level in self.levels:
            level[i] += change
            i //= 2


def trees_of(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, text, sizes): per row of ``docs`` its text and the tokens of each leaf, to be written and kept; this is the one time that whole texts are encoded."""
    vocabulary = vocabulary or default_vocabulary()

    def run(batches):
        code = encoder(vocabulary)
        for part in slices(batches, 1):
            sizes = [code.counts(leaves_of(t)) if t else [] for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sizes, pa.list_(pa.int32()))], ["doc_id", "text", "sizes"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, TREES)


class _Rows:
    """Results of a task, put out in batches."""

    def __init__(self, renewed: bool):
        self.renewed, self.rows, self.held = renewed, [], 0

    def add(self, doc_id: int | None, tag: int | None, copies: int, tree: TokenTree, before: int, n_edits: int) -> None:
        after = (tree.text, tree.sizes) if self.renewed else (None, None)
        self.rows.append((doc_id, tag, copies, before, tree.tokens, n_edits, tree.encoded, tree.chars, *after))
        self.held += tree.chars if self.renewed else 64

    def give(self, last: bool = False):
        if self.rows and (last or self.held >= 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows), _KINDS)], schema=_KINDS)
            self.rows, self.held = [], 0


def applied(trees: DataFrame, edits: DataFrame, vocabulary: str | None = None, renewed: bool = False) -> DataFrame:
    """Per row of ``trees``, a table as ``trees_of`` gives: its counts before and after its edits (doc_id, seq, at, length, replacement); with ``renewed`` also the text and sizes after them.

    Only trees with edits are shuffled, each distinct text of a doc_id once. A task reads a tree and
    then its edits one after the other, so neither of them is gathered.
    """
    vocabulary = vocabulary or default_vocabulary()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    change = edits.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("seq").cast("long").alias("seq"), zero("at"), zero("length"), F.coalesce("replacement", F.lit("")).alias("replacement"))
    edited = change.select("doc_id").distinct()
    rest = trees.join(edited, "doc_id", "left_anti")
    total = F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x)
    same = [F.lit(0).cast("long").alias("n_edits"), F.lit(0).cast("long").alias("n_encoded_chars"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars_after")]
    rest = rest.select("doc_id", total.alias("n_tokens"), total.alias("n_tokens_after"), *same, *(["text", "sizes"] if renewed else []))

    key = ["doc_id", "tag"]
    own = trees.join(edited, "doc_id", "left_semi").withColumn("tag", F.xxhash64("text")).groupBy(*key).agg(F.first("text").alias("text"), F.first("sizes").alias("sizes"), F.count("*").alias("copies"))
    own = Scratch(trees.sparkSession, "token-counts").keep(own, "edited")
    none = lambda kind: F.lit(None).cast(kind)
    each = own.select(*key, F.lit(0).alias("kind"), none("long").alias("seq"), none("long").alias("at"), none("long").alias("length"), "text", "sizes", "copies")
    moves = change.join(own.select(*key), "doc_id").select(*key, F.lit(1).alias("kind"), "seq", "at", "length", F.col("replacement").alias("text"), none("array<int>").alias("sizes"), none("long").alias("copies"))
    order = [*key, "kind", "seq", "at", "length", "text"]
    stream = each.unionByName(moves).repartition(*key).sortWithinPartitions(*order)

    def run(batches):
        code, out, now = encoder(vocabulary), _Rows(renewed), None
        for batch in batches:
            for doc, tag, kind, _, at, length, text, sizes, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if kind:
                    now[3].edit(at, length, text)
                    now[5] += 1
                    continue
                if now:
                    out.add(*now)
                    yield from out.give()
                tree = TokenTree(text or "", code.counts, sizes)
                now = [doc, tag, copies, tree, tree.tokens, 0]
        if now:
            out.add(*now)
        yield from out.give(last=True)

    names = [x.split(" ")[0] for x in COUNTED.split(", ")] + (["text", "sizes"] if renewed else [])
    done = stream.mapInArrow(run, _APPLIED).withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
    return done.select(*names).unionByName(rest)


def recount(docs: DataFrame, edits: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per row of ``docs``: tokens before and after its edits (doc_id, seq, at, length, replacement), and the characters encoded again. For documents whose trees are kept, use ``applied`` on these."""
    return applied(Scratch(docs.sparkSession, "token-counts").keep(trees_of(docs, vocabulary), "trees"), edits, vocabulary)


def applied_in_place(rows: DataFrame, vocabulary: str) -> DataFrame:
    """``rows``: doc_id, text, sizes and edits, a short list that the row itself brings."""

    def run(batches):
        code, out = encoder(vocabulary), _Rows(False)
        for part in slices(batches, 1):
            for doc, text, sizes, edits in zip(*(c.to_pylist() for c in part.columns)):
                tree = TokenTree(text or "", code.counts, sizes)
                before = tree.tokens
                for e in edits or []:
                    tree.edit(e["at"], e["length"], e["replacement"])
                out.add(doc, None, 1, tree, before, len(edits or []))
                yield from out.give()
        yield from out.give(last=True)

    return rows.select("doc_id", "text", "sizes", "edits").mapInArrow(run, _APPLIED).select(*[x.split(" ")[0] for x in COUNTED.split(", ")])


def sample_edits(docs: DataFrame) -> DataFrame:
    """The query's edits: every document gets a word in its middle, loses 5 characters at a third, and gets a line at its end."""
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    text = lambda x: F.lit(x)
    changes = F.array(
        F.struct(F.lit(0).cast("long").alias("seq"), F.floor(n / 2).alias("at"), F.lit(0).cast("long").alias("length"), text(" inserted").alias("replacement")),
        F.struct(F.lit(1).cast("long").alias("seq"), F.floor(n / 3).alias("at"), F.lit(5).cast("long").alias("length"), text("").alias("replacement")),
        F.struct(F.lit(2).cast("long").alias("seq"), (n + 1_000_000).alias("at"), F.lit(0).cast("long").alias("length"), text("\nlast line").alias("replacement")),
    )
    return docs.select("*", changes.alias("edits"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = Scratch(spark, "token-counts").keep(trees_of(spark.read.parquet(f"{sf_dir}/documents.parquet")), "trees")
    # these edits follow from each row itself, so they need no join
    return applied_in_place(sample_edits(trees), default_vocabulary())
