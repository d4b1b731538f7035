"""Operator 6: toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; a sample of the rows that were looked at, their
labels left out, is the unlabelled text. It is drawn from these rows because the class
prior p is their share of toxic ones: with text drawn from all documents, a labelling that
saw fewer toxic rows would give a prior that is too small for it, and toxic text of the
sample would be learnt as clean. With positive risks R and unlabelled risk U, the estimate
p * R(positive as 1) + max(0, U(as 0) - p * R(positive as 0)) is that of full supervision;
where the second part turns negative, the step goes back against overfitting.

Features of a text are presences of hashed words, word beginnings of 4 to 6 bytes and
word ends of 4 and 5 bytes. Those kept are the ``features`` whose share among positives
stands out most from their share among unlabelled text, by a one-sided z value; that
number is the size of the model. Training reads at most ``positives`` positive and
``unlabelled`` unlabelled rows, those of the smallest hashes of doc_id; all of these bounds
are parameters. Scoring reads every whole text, however long, in one pass without a
shuffle, about a megabyte of text at a time.

Nulls: a null text is empty, and like every text without a selected feature it scores
what the intercept gives. A null doc_id counts as the text "" for the held-out split, has
no label, isn't learnt from and is scored. With several labels of one doc_id the largest counts.
Repeated rows are scored each, alike; all rows of a chosen doc_id are learnt from. Ties of z are
broken by the feature's hash. Without any positive label in the training part, or with an
empty table, every score is 0 (below 1e-6). Extra columns, whatever their names, are not read by ``score``
and kept by ``keep_clean``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .textvec import Words, _bytes, _place, constants, mix, slices

POSITIVE_ROWS, UNLABELLED_ROWS, FEATURES, LEAST = 5_000, 15_000, 1024, 3
BEGIN, END = (4, 5, 6), (4, 5)
BITMAP = 22
THRESHOLD = 0.7


def word_features(words: Words) -> list[np.ndarray]:
    """Feature hashes of each word: itself, its beginnings and its ends; 0 where it is too short."""
    size = words.end - words.start
    out = [words.hash]
    for kind, sizes in enumerate((BEGIN, END)):
        total = np.zeros(len(size), np.uint64)
        done = 0
        for n in sizes:
            for j in range(done, n):
                at = words.start + j if kind == 0 else words.end - 1 - j
                total += _bytes[words.data[np.clip(at, 0, max(len(words.data) - 1, 0))]] * _place(np.full(1, j))[0] if len(size) else total
            done = n
            out.append(np.where(size > n, mix(total ^ constants(1, 90 + 10 * kind + n)[0]), np.uint64(0)))
    return out


class Model:
    """Selected features in ascending order, their weights, and the intercept."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float):
        self.features, self.weights, self.bias = features, weights, bias
        self.bitmap = np.zeros(1 << BITMAP, bool)
        self.bitmap[features >> np.uint64(64 - BITMAP)] = True

    def present(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature) of every selected feature of every text, once each."""
        doc = np.repeat(np.arange(len(words.counts)), words.counts)
        found = []
        for h in word_features(words):
            at = np.flatnonzero(self.bitmap[h >> np.uint64(64 - BITMAP)])
            if len(at) and len(self.features):
                place = np.minimum(np.searchsorted(self.features, h[at]), len(self.features) - 1)
                same = self.features[place] == h[at]
                found.append(doc[at[same]] * len(self.features) + place[same])
        both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return both // max(len(self.features), 1), both % max(len(self.features), 1)

    def score(self, words: Words) -> np.ndarray:
        doc, feature = self.present(words)
        z = self.bias + np.bincount(doc, self.weights[feature] if len(feature) else None, minlength=len(words.counts))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


class Rows:
    """Sparse rows of zeros and ones: the features of row i are ``at[first[i]:first[i + 1]]``."""

    def __init__(self, lists: list[np.ndarray], n: int):
        self.n = n
        self.size = np.array([len(x) for x in lists], np.int64)
        self.at = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(len(lists)), self.size)

    def __len__(self) -> int:
        return len(self.size)

    def margins(self, w: np.ndarray) -> np.ndarray:
        """The sum of each row's weights, and the intercept ``w[n]``."""
        return np.bincount(self.row, w[self.at], minlength=len(self)) + w[self.n]

    def pull(self, slope: np.ndarray) -> np.ndarray:
        """The gradient of the mean, from each row's slope."""
        return np.append(np.bincount(self.at, slope[self.row], minlength=self.n), slope.sum()) / len(self)


def fit(positive: Rows, unlabelled: Rows, prior: float, steps: int = 800, rate: float = 0.1, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Non-negative PU learning of a logistic classifier by Adam."""
    n = positive.n
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    loss = lambda z: np.logaddexp(0, -z)  # noqa: E731  of a margin
    slope = lambda z: -1 / (1 + np.exp(np.clip(z, -50, 50)))
    for t in range(1, steps + 1):
        zp, zu = positive.margins(w), unlabelled.margins(w)
        rest = loss(-zu).mean() - prior * loss(-zp).mean()
        g_rest = prior * positive.pull(slope(-zp)) - unlabelled.pull(slope(-zu))
        g = -g_rest if rest < 0 else prior * positive.pull(slope(zp)) + g_rest
        g[:n] += decay * w[:n]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:n], float(w[n])


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVE_ROWS, unlabelled: int = UNLABELLED_ROWS, features: int = FEATURES, least: int = LEAST) -> Model:
    """A model from the rows of ``docs`` that may be learnt from; ``features`` is its size, ``least`` how many positives a feature needs."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("h", F.xxhash64(F.lit(5), "doc_id"))
    total, toxic = known.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") == 1).cast("int")), F.lit(0))).first()
    if not toxic:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -50.0)
    prior = min(0.95, max(1 / (2 * total), toxic / total))
    pos = known.where("toxic = 1").orderBy("h", "doc_id").limit(positives).select("doc_id", F.lit(1).alias("p"))
    unl = known.orderBy("h", "doc_id").limit(unlabelled).select("doc_id", F.lit(1).alias("u"))
    part = scratch.keep(pos.join(unl, "doc_id", "full").select("doc_id", F.coalesce("p", F.lit(0)).alias("p"), F.coalesce("u", F.lit(0)).alias("u")), "sample")
    # the sample has a bounded number of ids
    texts = scratch.keep(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(part), "doc_id"), "texts")

    def count(batches):
        for part in slices(batches, "text"):
            words = Words(part.column("text"))
            p, u = (np.asarray(part.column(c)).astype(np.int64) for c in "pu")
            doc = np.repeat(np.arange(part.num_rows), words.counts)
            h = np.concatenate(word_features(words))
            doc = np.tile(doc, 1 + len(BEGIN) + len(END))
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))) if len(h) else np.zeros(0, np.int64)
            h, doc = h[new], doc[new]
            values, first = np.unique(h, return_index=True)
            sums = [np.add.reduceat(x[doc], first) if len(first) else np.zeros(0, np.int64) for x in (p, u)]
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), *map(pa.array, sums)], ["h", "p", "u"])

    np_, nu = texts.agg(F.sum("p"), F.sum("u")).first()
    if not np_ or not nu:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -50.0)
    counts = texts.mapInArrow(count, "h long, p long, u long").groupBy("h").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).where((F.col("h") != 0) & (F.col("p") >= least))
    # unlabelled text holds positives too: compare with what remains of it as negative
    negative = F.greatest((F.col("u") / nu - prior * F.col("p") / np_) / (1 - prior), F.lit(0.0)) + 0.5 / nu
    share = F.col("p") / np_
    z = (share - negative) / F.sqrt(share * (1 - share) / np_ + negative / nu + 1e-12) * F.log(share / negative)
    best = counts.where(share > 3 * negative).select("h", z.alias("z")).orderBy(F.desc("z"), "h").limit(features).collect()
    chosen = np.sort(np.array([r["h"] for r in best], np.int64).view(np.uint64))
    chooser = Model(chosen, np.zeros(len(chosen)), 0.0)

    def pick(batches):
        for part in slices(batches, "text"):
            doc, feature = chooser.present(Words(part.column("text")))
            lists = np.split(feature.astype("<u4"), np.searchsorted(doc, np.arange(1, part.num_rows)))
            yield pa.RecordBatch.from_arrays([part.column("p"), part.column("u"), pa.array([x.tobytes() for x in lists], pa.binary())], ["p", "u", "features"])

    # the bounded sample, a few selected features a row, as bytes
    rows = texts.mapInArrow(pick, "p int, u int, features binary").toArrow()
    scratch.drop(part, texts)
    lists = [np.frombuffer(x.as_buffer(), "<u4") for x in rows.column("features")]
    side = {c: np.asarray(rows.column(c)) for c in "pu"}
    w, bias = fit(*(Rows([x for x, own in zip(lists, side[c]) if own], len(chosen)) for c in "pu"), prior)
    return Model(chosen, w, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id and score."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(held.value.score(Words(part.column(1))))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with all its columns, without texts that score ``threshold`` or more."""
    held, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches):
        for part in slices(batches, place):
            yield part.filter(pa.array(held.value.score(Words(part.column(place))) < threshold))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, train(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
