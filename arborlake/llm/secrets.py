"""Operator 7: secrets, told apart by how widely they are copied.

Base spans are found by fixed patterns in whole texts. Their values, hashed, are counted
over the whole corpus by distinct repositories and distinct owners: a value that many
owners hold is a copied example, one that few owners hold and that looks random is live.
The method adds a span of kind ``repeat`` wherever a live value stands elsewhere as a bare
token, or as a part of one, that no base span touches; base spans always stay.

Values and tokens are compared without "." and "=" at their ends, which are full stops and
padding. A token also swallows what stands before and behind a value (``k=VALUE``,
``host/path/VALUE``), so each of its parts between "=", "/" and "." is looked up too, and so
is all that stands before or behind each of these signs: a value that holds such signs itself
is found at either end of a token, not between two others.

By default a source is an owner and each of its documents a repository, so a value that
is pasted into many documents of one source is a copied example as well.

One scan writes spans and hashes; the corpus-wide counts are aggregations in steps
(distinct repositories of a value and owner, distinct owners, their number), so a value in a
third of all documents is spread over its repositories before it is combined. Only hashes that occur as base values are matched with
tokens, by a join.

Offsets are code points, ends exclusive. Nulls: a null text is empty; a null repository
or owner counts as one of its own, ""; a null doc_id is kept. Repeated rows count once per
repository and owner, and each has its row in the result. Spans that begin at one place stand in the
order of the kinds. Texts are scanned whole, whatever their length, in time and memory linear in it: the parts of a token
are pairs of places, hashed from running sums over the token. An empty table gives no rows. Extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .textvec import mix, slices

# The patterns and least lengths of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "repeat")

TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
CUT, ENDS, DIGIT = re.compile(r"[=/.]+"), ".=", re.compile(r"[0-9]")
MAX_OWNERS, MAX_REPOSITORIES, ENTROPY = 2, 3, 3.0
FOUND = "doc_id long, repository string, owner string, base array<struct<kind:string,start:int,stop:int,hash:long,live:boolean>>, tokens array<struct<start:int,stop:int,hash:long>>"


class Hashes:
    """Hashes of substrings of one ASCII token, each in constant time: polynomials modulo two primes over running sums, and the length."""

    # Two primes below 2^31 and a base for each; the inverses of the bases take a sum back to its first character.
    MODULI = ((2147483647, 1000003), (2147483629, 998244353))
    _powers: list[tuple[np.ndarray, np.ndarray]] = []
    KEPT = 1 << 16

    @classmethod
    def powers(cls, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Powers of each base and of its inverse, up to ``n``; only those of short tokens are kept."""
        if n <= cls.KEPT and cls._powers:
            return cls._powers
        out = []
        for p, base in cls.MODULI:
            both = []
            for b in (base, pow(base, -1, p)):
                x = np.ones(1, np.int64)
                while len(x) <= max(n, cls.KEPT):
                    x = np.concatenate((x, x * pow(b, len(x), p) % p))
                both.append(x)
            out.append(tuple(both))
        if n <= cls.KEPT:
            cls._powers = out
        return out

    def __init__(self, token: bytes):
        self.tables = self.powers(len(token))
        x = np.frombuffer(token, np.uint8).astype(np.int64)
        self.sums = [np.concatenate(([0], np.cumsum(x * up[: len(x)] % p))) for (p, _), (up, _) in zip(self.MODULI, self.tables)]

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        one, two = ((s[stop] - s[start]) % p * down[start] % p for s, (p, _), (_, down) in zip(self.sums, self.MODULI, self.tables))
        return mix((one.astype(np.uint64) << np.uint64(31)) ^ two.astype(np.uint64) ^ mix((stop - start).astype(np.uint64))).view(np.int64)


def value_hash(value: str) -> int:
    return int(Hashes(value.encode()).of(np.array([0]), np.array([len(value)]))[0])


def looks_random(value: str) -> bool:
    """Letters and digits, and at least ``ENTROPY`` bits a character."""
    n = len(value)
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= ENTROPY


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, stop, value), leftmost non-overlapping for each kind."""
    out = [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def normal(start: int, value: str) -> tuple[int, str]:
    """The value as it is compared, and its place."""
    bare = value.lstrip(ENDS)
    return start + len(value) - len(bare), bare.rstrip(ENDS)


def candidates(token: str) -> tuple[np.ndarray, np.ndarray]:
    """(starts, stops) in order: the token, its parts, and what stands before or behind a cut, with a digit. Linear in the token."""
    n = len(token)
    cuts = np.array([m.span() for m in CUT.finditer(token)], np.int64).reshape(-1, 2)
    lead, tail = n - len(token.lstrip(ENDS)), len(token.rstrip(ENDS))
    zero, end = np.zeros(1, np.int64), np.full(1, n, np.int64)
    # raw bounds decide on length; then the ends lose what is not compared
    start = np.concatenate((zero, zero, cuts[:, 1], np.zeros(len(cuts), np.int64), cuts[:, 1]))
    stop = np.concatenate((end, cuts[:, 0], end, cuts[:, 0], np.full(len(cuts), n, np.int64)))
    keep = stop - start >= LEAST["assign"]
    pairs = np.unique(np.stack((np.maximum(start[keep], lead), np.minimum(stop[keep], tail)), 1), axis=0)
    digit = np.concatenate(([0], np.cumsum(np.frombuffer(token.encode(), np.uint8) - np.uint8(48) < 10, dtype=np.int64))) if len(pairs) else zero
    start, stop = pairs[:, 0], pairs[:, 1]
    keep = start < stop
    keep[keep] = digit[stop[keep]] > digit[start[keep]]
    return start[keep], stop[keep]


def merged(spans: list[tuple[str, int, int, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the union of spans that are in order of their starts."""
    out: list[list[int]] = []
    for _, a, b, _ in spans:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return tuple(np.array(out, np.int64).reshape(-1, 2).T)


def bare_tokens(text: str, spans: list[tuple[str, int, int, str]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, stops, hashes) of the candidates of each long token with a digit, without those that a base span touches."""
    out, (low, high) = [], merged(spans)
    for m in TOKEN.finditer(text):
        if not DIGIT.search(m[0]):
            continue
        start, stop = candidates(m[0])
        if len(low):
            at = np.searchsorted(high, start + m.start(), side="right")  # the first span that ends behind the start
            free = (at == len(low)) | (low[np.minimum(at, len(low) - 1)] >= stop + m.start())
            start, stop = start[free], stop[free]
        if len(start):
            out.append((start + m.start(), stop + m.start(), Hashes(m[0].encode()).of(start, stop)))
    return out


def scan(docs: DataFrame, repository: str, owner: str) -> DataFrame:
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("hash", pa.int64()), ("live", pa.bool_())])
    token = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("hash", pa.int64())])

    def run(batches):
        for batch in slices(batches, 3):
            base, found, sizes = [], [], []
            for text in batch.column(3):
                text = text.as_py() or ""
                spans = base_spans(text)
                values = [normal(0, v)[1] for *_, v in spans]
                base.append([{"kind": k, "start": a, "stop": b, "hash": value_hash(v), "live": looks_random(v)} for (k, a, b, _), v in zip(spans, values)])
                own = bare_tokens(text, spans)
                found += own
                sizes.append(sum(len(x[0]) for x in own))
            start, stop, hashed = (np.concatenate([np.zeros(0, np.int64), *(x[i] for x in found)]) for i in range(3))
            flat = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(stop, pa.int32()), pa.array(hashed)], fields=list(token))
            tokens = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(base, pa.list_(span)), tokens], ["doc_id", "repository", "owner", "base", "tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"), F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, FOUND)


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owners, repositories, live) of base values over the whole corpus."""
    each = found.select("repository", "owner", F.explode("base").alias("s")).select("repository", "owner", F.col("s.hash").alias("hash"), F.col("s.live").alias("random"))
    pairs = each.groupBy("hash", "owner", "repository").agg(F.max("random").alias("random"))
    repositories = pairs.groupBy("hash", "owner").agg(F.count("*").alias("r"), F.max("random").alias("random"))
    counts = repositories.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("r").alias("repositories"), F.max("random").alias("random"))
    return counts.select("hash", "owners", "repositories", (F.col("random") & (F.col("owners") <= MAX_OWNERS) & (F.col("repositories") <= MAX_REPOSITORIES)).alias("live"))


def find(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """Per row: doc_id and spans (kind, start, stop, hash, live), in order. ``live``: random looking and held by few owners."""
    scratch = Scratch(docs.sparkSession, "secrets")
    found = scratch.keep(scan(docs, repository, owner).withColumn("row", F.monotonically_increasing_id()), "found")
    values = scratch.keep(ownership(found), "values")
    order = F.when(F.col("kind") == "assign", 0).when(F.col("kind") == "access", 1).when(F.col("kind") == "hex", 2).otherwise(3)
    base = found.select("row", F.explode("base").alias("s")).select("row", "s.kind", "s.start", "s.stop", "s.hash")
    tokens = found.select("row", F.explode("tokens").alias("s")).select("row", F.lit("repeat").alias("kind"), "s.start", "s.stop", "s.hash")
    # few values are live and each of them in few documents, so a value of very many stands on one side of a join only
    live = values.where("live").select("hash", "live")
    repeats = tokens.join(live, "hash")
    # of repeats one within another, the outer one: what ends behind it begins before it, or with it and is longer
    before = Window.partitionBy("row").orderBy("start", F.desc("stop")).rowsBetween(Window.unboundedPreceding, -1)
    repeats = repeats.withColumn("reach", F.max("stop").over(before)).where("reach IS NULL OR reach < stop").drop("reach")
    spans = base.join(live, "hash", "left").withColumn("live", F.coalesce("live", F.lit(False))).unionByName(repeats)
    spans = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", order.alias("order"), "kind", "stop", "hash", "live"))).alias("spans"))
    return found.select("row", "doc_id").join(spans, "row", "left").select("doc_id", F.coalesce("spans", F.array().cast("array<struct<start:int,order:int,kind:string,stop:int,hash:bigint,live:boolean>>")).alias("spans"))


def redact(text: str, spans: list, mark: str = "[secret]") -> str:
    """The text with its live spans replaced."""
    out, at = [], 0
    for s in spans:
        if s["live"] and s["stop"] > at:
            out += [text[at : max(at, s["start"])], mark]
            at = s["stop"]
    return "".join([*out, text[at:]])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "repeat")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    live = F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live")
    return out.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"), live)
