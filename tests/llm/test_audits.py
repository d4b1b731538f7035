"""Operators 11 to 13 against brute-force versions, with nulls, ties, repeated rows, empty tables, long texts and clashing names."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborlake.llm import centroids, divergence, packing, tokenize

from .test_cases import CLASH, LONG, docs_of, mixed_rows

# 11 -------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute_audit(rows, least=30, top=50):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for text, lang, source in rows]
    with_it, count, everywhere, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, words in docs:
        with_it[lang].update(set(words))
        count[lang, source].update(words)
        everywhere[lang].update(words)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in with_it[lang].items() if n >= least]

        def shares(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(count[lang, s]) for s in sources}, shares(everywhere[lang])
        for s in sources:
            pair = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s))
            term = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t])[:top]
            out |= {(lang, s, part, item, -v, i + 1) for part, found in (("pair", pair), ("term", term)) for i, (v, _, item) in enumerate(found)}
    return out


def texts_of_sources():
    r = random.Random(11)
    vocabulary = [f"w{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(120)] + ["Éa", "é", "日本", "Straße", "ÄB"]
    rows = [(" ".join(r.choice(vocabulary[: 20 + 25 * (i % 4)]) for _ in range(r.randrange(60))) + r.choice([" A-b_c1D", "", "\x00X"]), ("en", "de", None)[i % 3], f"s{i % 4}") for i in range(240)]
    rows += [(None, "en", "empty"), ("", "fr", "lone"), ("only words that are rare", "fr", "lone"), ("solo", "it", None), ("1 2 3", None, "s9")] + [("Same same SAME text", "en", "s1")] * 35
    return rows + [("word " * 400_000 + "w" * 3_000_000, "en", "s2")]


def test_divergence(spark):
    rows = texts_of_sources()
    df = spark.createDataFrame([(i, t, lang, s) for i, (t, lang, s) in enumerate(rows)], "doc_id long, text string, lang string, source string").selectExpr("*", *CLASH.split(", "), "1 AS term", "2 AS n", "3 AS docs", "4 AS v").repartition(7)
    got = divergence.audit(df).collect()
    assert len(got) == len(want := brute_audit(rows)) and {(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in got} == want
    assert {r["value"] for r in got if r["lang"] == "it"} == set() and any(r["source"] == "empty" for r in got)
    low = {(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in divergence.audit(df, least=3, top=2).collect()}
    assert low == brute_audit(rows, 3, 2)


def test_divergence_in_parts(spark, monkeypatch):
    """Texts cut into pieces and counts sent early give the same."""
    text = "Alpha beta,GAMMA  delta" * 50 + "é" * 40
    for size in (1, 2, 7, 64):
        monkeypatch.setattr(divergence, "PIECE", size)
        assert [w for p in divergence.pieces(text.encode()) for w in p.split()] == [w.encode() for w in TERM.findall(text.translate(LOWER))]


def test_divergence_of_huge_counts(spark):
    big = spark.sql(f"SELECT {divergence._share('n', 'total', 'v')} AS p FROM VALUES (40000000000L, 90000000000L, 3L), (0L, 0L, 0L) AS t(n, total, v)").collect()
    assert [r["p"] for r in big] == [1 + 10**9 * (40000000000 + 5) // (90000000000 + 15), 0]


def test_divergence_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.audit(empty).collect() == []


# 12 -------------------------------------------------------------------------------------------


def brute_cluster(rows, k, rounds, d, scale=256, seed=2):
    kept = [(i, [math.floor(x) * scale if abs(x) > 1e16 else math.floor(scale * x) for x in v], v) for i, v in rows if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[2]))
    centers = [r[1] for r in order[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centers))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v, _ in kept:
            own[nearest(v)[1]].append(v)
        centers = [[sum(x) // len(own[i]) for x in zip(*own[i])] if own[i] else c for i, c in enumerate(centers)]
    found = [(i, *nearest(v)) for i, v, _ in kept]
    inertia = Counter()
    for _, f, c in found:
        inertia[c] += f
    fits = lambda x: x if x < 1 << 63 else None
    return Counter((i, c, fits(f), fits(inertia[c]), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest()) for i, f, c in found)


def vectors(d=4, n=300):
    r = random.Random(12)
    rows = [(i, [r.gauss(i % 7, 0.3) for _ in range(d)]) for i in range(n)]
    rows += [(n, None), (n + 1, []), (n + 2, [1.0] * (d + 1)), (n + 3, [1.0, None] + [0.0] * (d - 2)), (n + 4, [math.nan] + [0.0] * (d - 1)), (n + 5, [math.inf] + [0.0] * (d - 1))]
    rows += [(3, rows[3][1])] * 3 + [(5, rows[6][1]), (None, rows[9][1]), (None, [-0.0] * d), (n + 6, [-1 / 256 - 1e-12] * d)]
    return rows


@pytest.mark.parametrize("scale_up", [1.0, 1e6, 1e12, 1e200])
def test_centroids(spark, scale_up):
    rows = [(i, [x if x is None else x * scale_up for x in v] if v else v) for i, v in vectors()]
    rows += [(900, [1e7 * scale_up, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS cluster", "2 AS distance", "3 AS v", "4 AS part").repartition(5)
    got = centroids.cluster(df, 6, 5, 4)[0]
    assert Counter(tuple(r) for r in got.collect()) == brute_cluster(rows, 6, 5, 4)


def test_centroids_beyond_float64(spark):
    """Components whose scaled value overflows, beside small ones, of one table."""
    rows = [(i, [1.5e308 * (i % 3 - 1), float(i % 5)]) for i in range(40)]
    got = centroids.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 5, 2)[0]
    assert Counter(tuple(r) for r in got.collect()) == brute_cluster(rows, 5, 5, 2)


def test_centroids_kinds_and_bounds(spark):
    rows = [(i, [i % 9, -(i % 4)]) for i in range(60)]
    for kind in ("float", "int", "decimal(10,3)"):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<int>").withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
        assert Counter(tuple(r) for r in centroids.cluster(df, 4, 5, 2)[0].collect()) == brute_cluster(rows, 4, 5, 2)
    # fewer vectors than centroids, and none
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<int>").withColumn("embedding", F.col("embedding").cast("array<float>"))
    assert Counter(tuple(r) for r in centroids.cluster(few, 40, 5, 2)[0].collect()) == brute_cluster(rows[:3], 40, 5, 2)
    out, found = centroids.cluster(few.where("vec_id > 99"), 40, 5, 2)
    assert out.collect() == [] and found.shape == (0, 2) and out.schema == centroids.cluster(few, 2, 1, 2)[0].schema


def test_products_are_exact_up_to_the_guard():
    m = math.isqrt((centroids.EXACT - 1) // 64) // 2
    x = np.array([[m] * 64, [-m] * 64, [m - 1] * 64, [2.0 * m] * 64], float) / 256
    c = np.array([[-m] * 64, [m] * 64], object)
    found = [(int(i), int(n), int(f), kind.dtype == object) for at, nearest, far, kind in centroids.measured(x, c, 256) for i, n, f in zip(at, nearest, far)]
    assert found == [(0, 1, 0, False), (1, 0, 0, False), (2, 1, 64, False), (3, 1, 64 * m * m, True)]


# 13 -------------------------------------------------------------------------------------------


def plain_packer(lengths, size):
    """The rule, written out: all sums of squares for each choice."""
    gaps, out = [], []
    for n in lengths:
        best = None
        for gap in sorted({g for g in gaps if g >= n}):
            count = Counter(gaps)
            count[gap] -= 1
            if gap > n:
                count[gap - n] += 1
            score = sum(c * c for g, c in count.items())
            if best is None or score < best[0]:
                best = score, gap
        gap = best[1] if best else size
        out.append(size - gap)
        if best:
            gaps.remove(gap)
        if gap > n:
            gaps.append(gap - n)
    return out


def test_packer_takes_the_least_squares():
    r = random.Random(13)
    for order in (None, -1):
        lengths = [r.randrange(1, 33) for _ in range(400)]
        lengths = sorted(lengths, key=lambda n: -n) if order else lengths
        packer = packing.Packer(32)
        assert [packer.place(n)[1] for n in lengths] == plain_packer(lengths, 32)


def check_packing(rows, got, size, slack):
    ids = {t: [*tokenize.encoder(tokenize.default_vocabulary()).tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in {t for _, t in rows}}
    want = Counter()
    for i, t in rows:
        n, at = len(ids[t]), 0
        for k, stop in enumerate(packing.bounds(n, size)[1:]):
            part = ids[t][at:stop]
            want[i, k, at, len(part), struct.pack(f"<{len(part)}I", *part)] += 1
            assert len(part) == size or k == 0
            at = stop
        assert at == n
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        parts.sort()
        assert [a for a, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1].tolist()] and sum(n for _, n in parts) <= size
    least = -(-sum(n for parts in held.values() for _, n in parts) // size)
    assert len(held) <= least * slack + 1


def test_packing(spark):
    r = random.Random(14)
    rows = [(i, " ".join(f"word{r.randrange(500)}" for _ in range(min(600, int(r.expovariate(1 / 60)))))) for i in range(1500)]
    rows += [(i, t) for i, t, *_ in mixed_rows()]
    df = docs_of(spark, [(i, t, None, None) for i, t in rows]).selectExpr("*", "1 AS piece", "2 AS length", "3 AS offset", "4 AS ids").repartition(6)
    check_packing(rows, packing.pack(df).collect(), 1024, 1.005)
    got = packing.pack(df, size=100, group=300).collect()
    check_packing(rows, got, 100, 1.03)


def test_sequences_hold_their_documents(spark):
    rows = [(i, "a b c " * (i % 37)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    placed = packing.pack(df, size=64, group=50)
    by_place = {(r["doc_id"], r["piece"]): bytes(r["ids"]) for r in placed.collect()}
    seen = 0
    for s in packing.sequences(placed).collect():
        at = 0
        for part in s["documents"]:
            assert part["offset"] * 4 == at
            own = by_place[part["doc_id"], part["piece"]]
            assert bytes(s["ids"])[at : at + len(own)] == own and len(own) == 4 * part["length"]
            at += len(own)
            seen += 1
        assert at == len(s["ids"]) <= 4 * 64
    assert seen == len(by_place)


def test_packing_edges(spark):
    assert [packing.bounds(n, 4) for n in (1, 3, 4, 5, 8, 9)] == [[0, 1], [0, 3], [0, 4], [0, 1, 5], [0, 4, 8], [0, 1, 5, 9]]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(empty).collect() == [] and packing.sequences(packing.pack(empty)).collect() == []
    one = packing.pack(spark.createDataFrame([(None, None)], "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"]), r["offset"]) for r in one] == [(None, 0, 0, 1, struct.pack("<I", 2), 0)]


def test_packing_query_gives_the_digests(spark, tmp_path):
    docs = docs_of(spark, mixed_rows())
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packing.query(spark, str(tmp_path)).collect())
    assert got == Counter((r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(bytes(r["ids"]))) for r in packing.pack(docs).collect())
    assert len(LONG) > 1_000_000


# caches of the encoder --------------------------------------------------------------------------


def test_encoder_keeps_no_long_parts():
    """Parts and words of any length are counted and encoded alike, but only short ones are kept."""
    code = tokenize.Encoder(tokenize.default_vocabulary())
    parts = ["first", " short,", " " + "x" * 5000, " " + "語" * 300 + ".", " a\tb" * 40, " " + "y" * 63, " " + "z" * 64]
    exact = [len(code.tokenizer.encode(x, add_special_tokens=False).ids) for x in parts]
    for _ in range(2):
        assert code.counts(parts * 2) == exact * 2
        text = "".join(parts)
        assert b"".join(code.encode_all([text])[0]) == np.array(code.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
    assert all(len(x) <= code.LONGEST for kept in (code.sizes, code.words, code.cache) for x in kept) and " short," in code.sizes
