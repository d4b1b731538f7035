"""Nulls, ties, repeated rows, clashing names, empty and very long texts for each operator, and the measured recall of lossy searches."""

import hashlib
import io
import itertools
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from arborlake.llm import decontaminate, embed_dedup, line_dedup, minhash, mixing, secrets, textvec, token_counts, token_output, tokenize, toxicity, url_filter

from .test_llm import DOCS, WORD, brute_links, brute_mix, brute_windows, collect, union_find

CLASH = "1 AS removed, 2 AS lines, 'x' AS line, 3 AS hash, 'y' AS row, 'z' AS key, 4 AS tag, 5 AS kind, 6 AS copies, 7 AS node, 8 AS root, 9 AS rep, 10 AS comp, 11 AS items, 12 AS spans, 13 AS n_hit, 14 AS score, 15 AS p, 16 AS u, 17 AS tokens, 18 AS budget, 19 AS epoch, 20 AS weight, 21 AS capacity, 22 AS base, 23 AS owner, 24 AS sizes, 25 AS edits, 26 AS tie, 27 AS nth, 28 AS h1, 29 AS text_hash, 30 AS shard"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(120_000))


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], DOCS).selectExpr("*", *CLASH.split(", "))


def mixed_rows():
    """Null ids, texts, languages and sources, repeated rows, rows of one id, empty and very long texts."""
    text = "the quick brown fox jumps over the lazy dog and runs away"
    rows = [(1, text, "en", "src0"), (1, text, "en", "src0"), (None, text, "en", "src1"), (None, text, None, None), (None, None, None, None), (2, None, "en", "src0"), (3, "", None, "src0"), (4, LONG, "de", "src2"), (5, LONG + " end", "de", None), (1, "another text of the id one, and a long enough line", "en", "src0"), (6, "x", "en", "src0")]
    return rows + [(None, text, "en", "src1")] * 3


# slices ---------------------------------------------------------------------------------------


def test_slices_cover_all_rows():
    texts = ["a" * n for n in (0, 5, 3, 20, 1, 0, 0, 9, 4)] + [None, "b"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)))], ["t", "n"])
    for limit in (1, 8, 10, 1000):
        parts = list(textvec.slices([batch, batch.slice(3, 4), batch.slice(0, 0)], 0, limit))
        assert [n for p in parts for n in p.column("n").to_pylist()] == [*range(11), 3, 4, 5, 6]
        assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("t").to_pylist()) <= limit for p in parts)


# 1 --------------------------------------------------------------------------------------------


def test_token_output_cases(spark, tmp_path):
    e = tokenize.encoder(tokenize.default_vocabulary())
    got = token_output.token_output(docs_of(spark, mixed_rows()).repartition(5)).orderBy("start").collect()
    ids = lambda t: [*e.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
    want = Counter((i, len(x := ids(t)), zlib.crc32(struct.pack(f"<{len(x)}I", *x))) for i, t, *_ in mixed_rows())
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    order = [r["doc_id"] for r in got]
    assert order == sorted(order, key=lambda x: (x is not None, x))
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]


def test_width_follows_the_vocabulary(tmp_path):
    from tokenizers import Tokenizer, models

    assert token_output.width_of(tokenize.default_vocabulary(), 2) == 2
    assert token_output.width_of(tokenize.default_vocabulary(), 1 << 16) == 4
    path = str(tmp_path / "wide.json")
    Tokenizer(models.BPE({chr(0x4E00 + i): i for i in range(20_000)} | {chr(0x10000 + i): 20_000 + i for i in range(50_000)}, [])).save(path)
    assert token_output.width_of(path, 2) == 4


def test_frames_of_a_long_document(monkeypatch):
    monkeypatch.setattr(token_output, "FRAME_IDS", 10)
    out = io.BytesIO()
    writer = token_output.ShardWriter(out, 4)
    docs = [(None, [70_000]), (3, list(range(95))), (7, [])]
    for doc, ids in docs:
        writer.add(doc, np.array(ids, "<u4").tobytes())
    writer.close()
    reader = token_output.ShardReader(out, len(out.getvalue()), 4)
    assert reader.frames.tolist() == [1, 10, 1] and reader.find(3) == [1]
    assert [np.concatenate(list(reader.frames_of(i))).tolist() for i in range(3)] == [ids for _, ids in docs]


# 2 --------------------------------------------------------------------------------------------


def test_line_dedup_cases(spark):
    a, near = "a line that is long enough", "a line that is long enaugh"
    rows = [(None, f"{a}\nshort", "en", "s"), (None, f"{a}\nshort", "en", "s"), (None, f"other words stand here\n{near}", "en", "s"), (5, f"{near}\n {near}", "en", "s"), (5, f"{near}\n {near}", "en", "s"), (7, None, "en", "s"), (8, "", "en", "s"), (9, "y" * 30_000 + "\n" + "y" * 29_999, "en", "s"), (None, None, None, None)]
    out = line_dedup.remove_lines(docs_of(spark, rows))
    assert out.columns == [*docs_of(spark, rows).columns, "__lines", "__removed"]
    got = sorted(((r["doc_id"], r["text"], r["__removed"], r["removed"]) for r in out.collect()), key=str)
    # of document 5 the second line stands later and within one edit; ids that are null come last and tie
    want = [(None, "short", 1, 1)] * 2 + [(None, "other words stand here", 1, 1)] + [(5, near, 1, 1)] * 2 + [(7, None, 0, 1), (8, "", 0, 1), (9, "y" * 30_000, 1, 1), (None, None, 0, 1)]
    assert got == sorted(want, key=str)
    exact = collect(line_dedup.remove_lines(docs_of(spark, [(1, f"{a}\n{near}\n{a}", "en", "s"), (2, f"{near}!", "en", "s")]), edits=0))
    assert exact[1]["text"] == f"{a}\n{near}" and exact[2]["text"] == f"{near}!"
    least = collect(line_dedup.remove_lines(docs_of(spark, [(1, "ab\nab", "en", "s")]), least=2))
    assert least[1]["text"] == "ab"
    with pytest.raises(ValueError):
        line_dedup.decide(docs_of(spark, rows), edits=2)


# 3 --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [1 << 20, 60])
def test_decontaminate_cases(spark, limit):
    fox = "the quick brown fox jumps over the lazy dog and runs"
    items = [("b", fox), ("b", fox), ("a", fox.upper()), (None, fox), ("c", "solo"), ("d", None), ("e", " ".join(LONG.split(" ")[50_000:50_030]))]
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = mixed_rows()
    got = decontaminate.find(docs_of(spark, rows), bench, limit=limit).collect()
    want = Counter((i, *x[:2], tuple(x[2])) for (i, *_), x in zip(rows, brute_windows([t for _, t, *_ in rows], items)))
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got) == want
    left = decontaminate.decontaminate(docs_of(spark, rows), bench, limit=limit)
    assert left.count() == sum(n for (_, _, hit, _), n in want.items() if not hit) and left.columns == docs_of(spark, rows).columns


# 4 --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bins", [3, 4096])
def test_mixing_cases(spark, monkeypatch, bins):
    monkeypatch.setattr(mixing, "BIN", bins)
    r = random.Random(17)
    rows = [(i, " ".join("w" for _ in range(r.randint(0, 9))), r.choice(["en", None]), r.choice(["src1", None, "other"])) for i in range(60)]
    rows += [(i, None, None, None) for i in range(60, 63)]
    weights = {"domain": {"web": 5}, "lang": {"en": 3}, "source": {"src1": 4}}
    docs = docs_of(spark, rows)
    out = mixing.mix(docs, weights, 0.6, 2, 17)
    assert set(docs.columns) <= set(out.columns)
    got = [(x["doc_id"], x["__mix_epoch"], x["tokens"], x["budget"], x["epoch"]) for x in out.collect()]
    assert sorted(g[:2] for g in got) == brute_mix([(*x, 0) for x in rows], weights, 0.6, 2, 17) and {g[2:] for g in got} == {(17, 18, 19)}
    # equal rows and rows without an id are taken together
    same = mixing.mix(docs_of(spark, [(1, "a b c", "en", "src1")] * 4 + [(None, "d e", "en", "src1")] * 3), {}, 1.0, 1, 17)
    assert sorted(Counter(x["doc_id"] for x in same.collect()).items(), key=str) == [(1, 4), (None, 3)]


# 5 --------------------------------------------------------------------------------------------


def planted_vectors(n, d, seed):
    g = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        centre = g.standard_normal(d)
        centre /= np.linalg.norm(centre)
        for _ in range(g.integers(1, 12)):
            x = centre + g.uniform(0.1, 0.4) * g.standard_normal(d) / math.sqrt(d)
            rows.append((len(rows), (x / np.linalg.norm(x)).tolist(), int(i % 2)))
    return rows


def test_embeddings_recall(spark):
    rows = planted_vectors(300, 48, 3)
    x, label = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    close = (x @ x.T >= 0.93) & (label[:, None] == label[None]) & ~np.eye(len(x), dtype=bool)
    assert close.sum() > 2000
    got = collect(embed_dedup.near(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), 0.93), "vec_id")
    found = sum(got[i]["n_links"] for i in range(len(rows)))
    assert found == close.sum()  # a recall of 1; the tests and README ask for 0.9
    # loose parameters lose links, but none of those found is wrong
    loose = collect(embed_dedup.near(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), 0.93, miss=0.3, sigmas=1.0), "vec_id")
    assert all(loose[i]["n_links"] <= got[i]["n_links"] for i in got) and sum(r["n_links"] for r in loose.values()) < found


def test_embeddings_cases(spark):
    one, exact = [1.0, 0.0, 0.0, 0.0], [0.93, math.sqrt(1 - 0.93**2), 0.0, 0.0]
    rows = [(1, one, 5), (1, one, 5), (2, one, 5), (3, exact, 5), (4, one, 6), (None, one, 5), (5, [-0.0, 1.0, 0.0, 0.0], 5), (6, [0.0, 2.0, 0.0, 0.0], 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", *CLASH.split(", "), "1 AS v", "2 AS a", "3 AS b", "4 AS code", "5 AS component_id", "6 AS n_links", "7 AS ok")
    cosine = np.array(one) @ np.array(exact) / np.linalg.norm(exact)
    linked = int(cosine >= 0.93)
    got = Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embed_dedup.near(df).collect())
    want = [(1, 1 + linked, 1, True)] * 2 + [(2, 1 + linked, 1, False), (3, 2 * linked, 1 if linked else 3, not linked), (4, 0, 4, True), (None, 0, None, True), (5, 1, 5, True), (6, 1, 5, False)]
    assert got == Counter(want)


# 6 --------------------------------------------------------------------------------------------

ALL = (1 << 64) - 1


def plain_mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & ALL
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & ALL
    return x ^ x >> 31


def plain_features(text):
    """Hashes of words, beginnings and ends, one text and one byte at a time."""
    place = lambda j: int(textvec._places[j]) if j < 64 else plain_mix(j) | 1
    total = lambda data: sum(int(textvec._bytes[c]) * place(j) for j, c in enumerate(data)) & ALL
    out = set()
    for word in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode()):
        out.add(plain_mix(total(word)))
        for kind, sizes in enumerate((toxicity.BEGIN, toxicity.END)):
            for n in sizes:
                if len(word) > n:
                    part = word[:n] if kind == 0 else word[::-1][:n]
                    out.add(plain_mix(total(part) ^ int(textvec.constants(1, 90 + 10 * kind + n)[0])))
    return out


def test_toxicity_scores_by_hand(spark):
    r = random.Random(2)
    words = ["".join(r.choice("abcdé") for _ in range(r.randint(1, 9))) for _ in range(200)] + ["Z" * 90]
    rows = []
    for i in range(400):
        t = [r.choice(words) for _ in range(r.randint(3, 30))] + (["Awfulword", "horrible"][i % 2 :] if i % 4 == 0 else [])
        rows.append((i, " ".join(t), "en", "src"))
    docs = docs_of(spark, [*rows, (3, rows[3][1], "en", "src"), (None, rows[0][1], None, None), (None, None, None, None), (401, LONG, "en", "src")])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(8, 0), (None, 1), (9, None), (0, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    weights = dict(zip(model.features.tolist(), model.weights.tolist()))
    assert 0 < len(weights) <= toxicity.FEATURES
    got = toxicity.score(docs, model).collect()
    texts = [t for _, t, *_ in rows] + [rows[3][1], rows[0][1], None, LONG]
    by_text = {t: 1 / (1 + math.exp(-(model.bias + sum(weights.get(h, 0.0) for h in plain_features(t))))) for t in texts}
    ids = [i for i, *_ in rows] + [3, None, None, 401]
    want = sorted((str(i), by_text[t]) for i, t in zip(ids, texts))
    have = sorted((str(x["doc_id"]), x["score"]) for x in got)
    assert [i for i, _ in want] == [i for i, _ in have] and np.allclose([s for _, s in want], [s for _, s in have])
    small = toxicity.train(docs, labels, features=5, least=2)
    assert len(small.features) <= 5
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(s < toxicity.THRESHOLD for _, s in have)


def test_sparse_learning_equals_dense():
    g = np.random.default_rng(4)
    x = g.random((60, 12)) < 0.3
    rows = toxicity.Rows([np.flatnonzero(v) for v in x], 12)
    w, slope = g.standard_normal(13), g.standard_normal(60)
    assert np.allclose(rows.margins(w), x @ w[:12] + w[12])
    assert np.allclose(rows.pull(slope), np.append(x.T @ slope, slope.sum()) / 60)


# 7 --------------------------------------------------------------------------------------------


def brute_secrets(rows):
    """All columns of the query, by looking at every text by itself and comparing every value with every token."""
    kinds = {"assign": (r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 12), "access": (r"(AKIA[A-Z0-9]+)", 18), "hex": (r"([0-9a-f]+)", 16)}
    base, owners, places, random_looking = [], defaultdict(set), defaultdict(set), {}
    for doc, text, _, source in rows:
        found = []
        for k, (pattern, least) in kinds.items():
            for m in re.finditer(pattern, text or "", re.ASCII | (re.IGNORECASE if k == "assign" else 0)):
                if len(m[1]) >= least:
                    found.append((m.start(), list(kinds).index(k), k, m.end(), m[1].strip(".=")))
        base.append(sorted(found))
        for *_, value in found:
            owners[value].add(source or "")
            places[value].add((source or "", "" if doc is None else str(doc)))
            n = len(value)
            random_looking[value] = any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and -sum(value.count(c) / n * math.log2(value.count(c) / n) for c in set(value)) >= 3
    live = {v for v in owners if random_looking[v] and len(owners[v]) <= 2 and len(places[v]) <= 3}
    for (doc, text, *_), found in zip(rows, base):
        spans = []
        for m in re.finditer(r"[A-Za-z0-9+/_.=-]{12,}", text or ""):
            token, at = m[0], m.start()
            cuts = [(c.start(), c.end()) for c in re.finditer(r"[=/.]+", token)]
            edges = [(0, 0), *cuts, (len(token), len(token))]
            pieces = [(0, len(token))] + [(a[1], b[0]) for a, b in zip(edges, edges[1:])] + [(0, c[0]) for c in cuts] + [(c[1], len(token)) for c in cuts]
            for a, b in pieces:
                if b - a >= 12:
                    value = token[a:b].strip(".=")
                    a += len(token[a:b]) - len(token[a:b].lstrip(".="))
                    if value in live and not any(s < at + a + len(value) and at + a < e for s, _, _, e, _ in found):
                        spans.append((at + a, 3, "repeat", at + a + len(value)))
        spans = {s for s in spans if not any(t[0] <= s[0] and t[3] >= s[3] and t[3] - t[0] > s[3] - s[0] for t in spans)}
        say = lambda xs: ",".join(f"{k}:{a}:{b}" for a, _, k, b in xs)
        own = [s[:4] for s in found]
        every = sorted([*own, *spans])
        yield (doc, *(sum(k == s[2] for s in own) for k in kinds), hashlib.sha256(say(own).encode()).hexdigest(), say(every), sum(v in live for *_, v in found) + len(spans))


def test_secrets_against_brute_force(spark, tmp_path):
    r = random.Random(21)
    pick = lambda n, chars="ABCDEFabcdef0123456789xyzXYZ": "".join(r.choice(chars) for _ in range(n))
    values = [pick(r.randint(10, 24)) for _ in range(25)] + [pick(20, "0123456789abcdef") for _ in range(5)] + ["AKIA" + pick(15, "ABCDEFGH1234") for _ in range(4)] + ["a1" * 8, "abcdefghijklmnop", "aB3/cD4=eF5.gH6"]
    forms = ["password={}", 'Secret: "{}"', "api_key = '{}'", "{}", "k={}", "host.example/path/{}/x", "{}.", "see {}==", "é {} ü", "TOKEN:{}", "{}/{}", "x{}"]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(r.randint(0, 5)):
            v = values[min(int(r.expovariate(0.12)), len(values) - 1)]
            parts.append(r.choice(forms).replace("{}", v))
        rows.append((i, " ".join(parts), "en", r.choice(["src0", "src0", "src1", "src2", None])))
    rows += [(None, rows[3][1], None, None), (None, None, None, None), rows[5], rows[5], (200, "", "en", "src0"), (201, LONG + " password=" + values[0], "en", "src0")]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = secrets.query(spark, f"file://{tmp_path}")
    got = Counter((x["doc_id"], x["n_assign"], x["n_access"], x["n_hex"], x["base_sha256"], x["spans"], x["n_live"]) for x in out.collect())
    want = Counter(brute_secrets(rows))
    assert got == want
    assert sum(n for k, n in want.items() if "repeat" in k[5]) > 5


# 8 --------------------------------------------------------------------------------------------


def test_urls_cases(spark):
    deep = ".".join(["a"] * 300) + ".org"
    pages = [(1, f"http://{deep}/x", None), (2, f"http://{deep}/x", None), (None, "http://b.org/", None), (None, None, None), (3, "http://", ""), (4, "http://./", ""), (5, "http://u.com/x", "y" * 500_000 + '<a href="//V.com/">'), (6, "http://v.com/de/1", ""), (7, "http://v.com/fr/1", ""), (8, "http://w.com/y", ""), (9, "HTTP://W.COM:80/de/", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS path", "3 AS rule", "4 AS rules", "5 AS trust", "6 AS src", "7 AS dst", "8 AS side", "9 AS fit")
    got = sorted(((r["page_id"], r["host"], r["rule"], r["verdict"]) for r in url_filter.judge(df, url_filter.RULES).collect()), key=str)
    want = [(1, deep, "org/", "allow"), (2, deep, "org/", "allow"), (None, "b.org", "org/", "allow"), (None, "", None, "allow"), (3, "", None, "allow"), (4, ".", None, "allow"), (5, "u.com", None, "block"), (6, "v.com", "com/de/", "block"), (7, "v.com", "com/fr/", "allow"), (8, "w.com", None, "allow"), (9, "w.com:80", None, "allow")]
    assert got == sorted(want, key=str)
    # no rule decides a page: no seeds
    assert {r["verdict"] for r in url_filter.judge(df.where("page_id = 5"), url_filter.RULES).collect()} == {"allow"}


def test_urls_follow_what_rules_decide(spark):
    """A host with more blocked pages than allowed ones is blocked elsewhere too, and so is who links to it."""
    pages = [(i, f"http://bad.com/de/{i}", "") for i in range(5)] + [(10, "http://bad.com/fr/1", ""), (11, "http://bad.com/other", "")]
    pages += [(20 + i, f"http://good.com/fr/{i}", '<a href="https://friend.net/">') for i in range(5)] + [(30, "http://good.com/de/1", ""), (31, "http://good.com/other", ""), (40, "http://linker.net/", '<a href="http://bad.com/x">'), (41, "http://friend.net/", ""), (42, "http://alone.info/", '<a href="/here">')]
    got = collect(url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), url_filter.RULES), "page_id")
    assert {i: got[i]["verdict"] for i in (11, 31, 40, 41, 42)} == {11: "block", 31: "allow", 40: "block", 41: "allow", 42: "allow"}
    hosts = {r["host"]: (r["trust"], r["distrust"]) for r in got.values()}
    assert hosts["alone.info"] == (0, 0) and hosts["bad.com"][1] > hosts["bad.com"][0]


# 9 --------------------------------------------------------------------------------------------


def test_minhash_recall(spark):
    """Pairs a little above the threshold, which are the ones that a signature may miss."""
    r = random.Random(31)
    texts = []
    for i in range(150):
        words = [f"w{i}x{j}" for j in range(60)]
        texts.append(" ".join(words))
        for k in range(2):
            other = list(words)
            other[[0, 59][k]] = f"n{i}{k}"
            if i % 2:
                other[r.randrange(25, 35)] = "m"
            texts.append(" ".join(other))
    _, pairs = brute_links(texts, WORD, 5, 80)
    got = collect(minhash.links_of(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    together = sum(got[a]["component_id"] == got[b]["component_id"] for a, b in pairs)
    assert len(pairs) > 300 and together == len(pairs)


@pytest.mark.parametrize("percent", [50, 65])
def test_minhash_recall_below(spark, percent):
    """Pairs at or a little above lower thresholds: the signature follows the threshold."""
    r = random.Random(percent)
    texts = []
    for i in range(80):
        words = [f"w{i}x{j}" for j in range(104)]
        texts.append(" ".join(words))
        # k new words at the end replace k of 100 shingles: 100 - k are shared of 100 + k
        for k in (int(100 * (100 - percent) / (100 + percent)), r.randint(5, 15)):
            texts.append(" ".join(words[: 104 - k] + [f"n{i}k{k}j{j}" for j in range(k)]))
    _, pairs = brute_links(texts, WORD, 5, percent)
    got = collect(minhash.links_of(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), percent=percent))
    together = sum(got[a]["component_id"] == got[b]["component_id"] for a, b in pairs)
    assert len(pairs) > 150 and together == len(pairs)
    assert {x["component_id"] for x in got.values()} == set(range(0, 240, 3))


def test_minhash_index():
    """Chunks and places follow from the threshold and what may be missed; at the defaults they are those the README's figures were taken with."""
    at = minhash.Index()
    assert (at.chunks, at.places, at.far) == (10, 50, 27)
    assert minhash.Index(50).chunks > minhash.Index(65).chunks > at.chunks < minhash.Index(80, 1e-9).chunks
    assert (minhash.Index(100).chunks, minhash.Index(100).far) == (1, 0)
    g = np.random.default_rng(3)
    for percent in (50, 65, 80):
        # places of signatures at the threshold, drawn as they are distributed
        how = minhash.Index(percent, 1e-3)
        differ = g.random((20_000, how.chunks, 5)) >= percent / 100
        lost = (differ.sum(2) > 1).all(1) | (differ.sum((1, 2)) > how.far)
        assert lost.mean() < 2e-3
    for percent, miss in ((0, 0.1), (101, 0.1), (80, 0), (80, 1)):
        with pytest.raises(ValueError):
            minhash.Index(percent, miss)


def test_shared_items_in_slices(monkeypatch):
    monkeypatch.setattr(minhash, "ITEMS", 7)
    g = np.random.default_rng(5)
    x, y = ([np.unique(g.integers(0, 60, n)).astype(np.uint32) for n in (1, 20, 40)] for _ in range(2))
    assert minhash._shared_items(x, y).tolist() == [[len(np.intersect1d(a, b)) for b in y] for a in x]


@pytest.mark.parametrize("small", [2, 16])
def test_minhash_cases(spark, small):
    rows = mixed_rows()
    got = minhash.links_of(docs_of(spark, rows), small=small).collect()
    ids = [i for i, *_ in rows]
    assert Counter(r["doc_id"] for r in got) == Counter(ids)
    assert {r["component_id"] for r in got if r["doc_id"] == 5} == {4} and {r["component_id"] for r in got if r["doc_id"] == 1} == {1}
    assert all(r["kept"] for r in got if r["doc_id"] is None)
    kept = minhash.keep_first(docs_of(spark, rows), small=small)
    assert sorted(str((r["doc_id"], r["n_chars"])) for r in kept.collect()) == sorted(str((i, len(t or ""))) for i, t, *_ in [rows[0], rows[4], rows[5], rows[6], rows[7], rows[9], rows[10]])


# 10 -------------------------------------------------------------------------------------------


def test_kept_trees(spark):
    e = tokenize.encoder(tokenize.default_vocabulary())
    count = lambda t: len(e.tokenizer.encode(t, add_special_tokens=False).ids)
    rows = mixed_rows()
    trees = token_counts.trees_of(docs_of(spark, rows)).cache()
    assert all(sum(r["sizes"]) == count(r["text"] or "") for r in trees.collect())
    moves = [(1, 0, 4, 5, "slow"), (1, 1, 0, 0, None), (4, None, 10, 3, "é"), (None, 0, 0, 9, "x"), (77, 0, 0, 0, "x")] + [(5, k, 50_000, 1, "yz ") for k in range(300)]
    edits = spark.createDataFrame(moves, "doc_id long, seq int, at int, length int, replacement string")

    def after(doc, text):
        for d, _, at, n, new in sorted((m for m in moves if m[0] == doc and doc is not None), key=lambda m: -1 if m[1] is None else m[1]):
            text = text[:at] + (new or "") + text[at + n :]
        return text

    got = token_counts.applied(trees, edits, renewed=True).collect()
    want = Counter((i, count(t or ""), count(after(i, t or "")), sum(m[0] == i for m in moves) if i is not None else 0, after(i, t or "")) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_tokens_after"], r["n_edits"], r["text"] or "") for r in got) == want
    assert all(sum(r["sizes"]) == r["n_tokens_after"] for r in got)
    long = next(r for r in got if r["doc_id"] == 5)
    assert long["n_encoded_chars"] < 300 * 200 < len(LONG)
    # the next edits start from the renewed table
    again = token_counts.applied(spark.createDataFrame([(r["doc_id"], r["text"], r["sizes"]) for r in got], token_counts.TREES), edits.where("doc_id = 4")).where("doc_id = 4").first()
    assert again["n_tokens"] == count(after(4, LONG)) and again["n_tokens_after"] == count(after(4, after(4, LONG)))


@pytest.mark.parametrize("long, block", [(64, 3), (3, 2), (0, 1)])
def test_inner_leaves(monkeypatch, long, block):
    """Leaves between pre-tokens: counts stay those of whole texts, and edits give the leaves that the edited text has by itself."""
    monkeypatch.setattr(token_counts, "LONG", long)
    monkeypatch.setattr(token_counts.TokenTree, "BLOCK", block)
    e, r = tokenize.encoder(tokenize.default_vocabulary()), random.Random(long)
    count = lambda t: len(e.tokenizer.encode(t, add_special_tokens=False).ids)
    part = ["a", "the", " ", "  ", "\n", "\t", "'s", "'", "é", "12", "7", ".", "!", "日本", "。", "，", "\x85", "\u3000", "\xa0", " x", "<|endoftext|>", "don't", "'re", "+", "=", "/", "ж", "!'s"]
    say = lambda n: "".join(r.choice(part) for _ in range(r.randint(0, n)))
    for _ in range(300):
        text = say(r.choice((8, 60)))
        tree = token_counts.TokenTree(text, e.counts)
        for _ in range(4):
            at, n, new = r.randint(0, len(text) + 2), r.choice((0, 1, 3, 20)), say(5)
            tree.edit(at, n, new)
            at = min(at, len(text))
            text = text[:at] + new + text[at + n :]
            assert [x for parts, _ in tree.blocks for x in parts] == token_counts.leaves_of(text)
            assert (tree.tokens, tree.chars, tree.text) == (count(text), len(text), text)


@pytest.mark.parametrize("text", ["word\tx\n" * 9000, "字母表示文字。" * 4000, "aB3/x+9=" * 20000])
def test_edits_of_texts_without_spaces(text):
    """What an edit encodes again is bounded, whatever the length of a text without spaces."""
    e = tokenize.encoder(tokenize.default_vocabulary())
    tree = token_counts.TokenTree(text, e.counts)
    for k in range(50):
        tree.edit(len(text) * k // 50, 2, "ab")
    assert tree.encoded < 50 * 250
    assert tree.tokens == len(e.tokenizer.encode(tree.text, add_special_tokens=False).ids)


def test_query_of_edits(spark, tmp_path):
    e = tokenize.encoder(tokenize.default_vocabulary())
    docs_of(spark, mixed_rows()).write.parquet(f"{tmp_path}/documents.parquet")
    got = token_counts.query(spark, f"file://{tmp_path}").collect()

    def after(text):
        n = len(text)
        text = text[: n // 2] + " inserted" + text[n // 2 :]
        text = text[: n // 3] + text[n // 3 + 5 :]
        return text + "\nlast line"

    want = Counter((i, len(e.tokenizer.encode(after(t or ""), add_special_tokens=False).ids), len(after(t or ""))) for i, t, *_ in mixed_rows())
    assert Counter((r["doc_id"], r["n_tokens_after"], r["n_chars_after"]) for r in got) == want


# pipeline -------------------------------------------------------------------------------------


def pipeline_tables(spark, folder, rows, labels, items):
    docs_of(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_pipeline_of_odd_rows(spark, tmp_path):
    pipeline_tables(spark, tmp_path, mixed_rows(), [(1, 1, 0), (None, None, None)], [(None, None), ("a", "")])
    got = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    # one row of each group of near copies, and none without words
    assert {r["doc_id"] for r in got} == {1, 4, 6} and all(r["n_tokens"] > 1 for r in got)


def test_pipeline_of_empty_tables(spark, tmp_path):
    pipeline_tables(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0


def test_all_pairs_of_sets_agree():
    """The edit test of lines against plain distance, over all short words."""
    words = ["".join(w) for n in range(4) for w in itertools.product("ab", repeat=n)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    assert all(line_dedup.within_one(a, b) == (distance(a, b) <= 1) for a in words for b in words)
    assert union_find([1, 2, 3], [(2, 3)]) == {1: 1, 2: 2, 3: 2}


def test_secrets_in_long_tokens(spark):
    """Tokens of megabytes: time and memory follow their length, and what is in them is found."""
    import time
    import tracemalloc

    r = random.Random(31)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    text = "".join(r.choices(chars, k=2_000_000))
    spent = []
    secrets.Hashes.powers(1)
    for n in (250_000, 500_000, 1_000_000, 2_000_000):
        tracemalloc.start()
        begin = time.perf_counter()
        secrets.bare_tokens(text[:n], [])
        spent.append((time.perf_counter() - begin, tracemalloc.get_traced_memory()[1]))
        tracemalloc.stop()
    assert spent[-1][1] < 300e6 and spent[-1][1] < 10 * spent[0][1] and spent[-1][0] < 20 * max(spent[0][0], 0.05)
    live = "Zx9Qw8Er7Ty6Ui5Op4As"
    dotted = ".".join("a1" for _ in range(100_000))
    rows = [(1, f"password={live}", "en", "s"), (2, f"data:image/png;base64,{text[:1_000_000]}/{live}", "en", "s"), (3, f"{dotted}={live}", "en", "t"), (4, text[:1_000_000] + " token: " + text[1_000_000:] + "==", "en", "t"), (5, text[1_000_000:].strip("/"), "en", "t")]
    got = collect(secrets.find(docs_of(spark, rows)))
    found = {i: [(s["kind"], s["start"], s["stop"]) for s in x["spans"]] for i, x in got.items()}
    assert found[1] == [("assign", 0, 29)] and found[2] == [("repeat", 22 + 1_000_001, 22 + 1_000_021)] and found[3] == [("repeat", len(dotted) + 1, len(dotted) + 21)]
    assert found[4][-1] == ("assign", 1_000_001, 2_000_010) and ("repeat", 0, len(rows[4][1])) in found[5]


def test_secret_hashes_are_those_of_substrings():
    r = random.Random(32)
    for n in (12, 90, 3000, 70_000):
        token = "".join(r.choices("abc123+/=.", k=n))
        start, stop = secrets.candidates(token)
        assert secrets.Hashes(token.encode()).of(start, stop).tolist()[:300] == [secrets.value_hash(token[a:b]) for a, b in zip(start[:300], stop[:300])]


def test_decontaminate_holds_one_group_at_a_time(spark):
    """A limit of a tenth of the benchmark: groups within it, one Python worker in any plan, and the same result."""
    r = random.Random(33)
    word = lambda: f"w{r.randrange(3000)}"
    items = [(f"i{i}", " ".join(word() for _ in range(r.randrange(1, 40)))) for i in range(120)] + [("i1", "once more"), ("i1", "once more")]
    rows = [(i, " ".join([word() for _ in range(20)] + ([items[i % 120][1]] if i % 3 else []) + [word() for _ in range(9)]), "en", "s") for i in range(150)] + mixed_rows()
    bench, docs = spark.createDataFrame(items, "item_id string, text string"), docs_of(spark, rows)
    limit = sum(len(t) for _, t in items) // 10
    groups = decontaminate.item_groups(bench, limit=limit)
    sizes = [[len(x["text"]) for x in g.collect()] for g in groups]
    assert len(groups) >= 10 and all(sum(x) <= limit or len(x) == 1 for x in sizes) and sum(map(len, sizes)) == len(set(items))
    for remove in ("document", "span"):
        many = decontaminate.decontaminate(docs, bench, remove=remove, limit=limit)
        assert many._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") <= 1 and many.columns == docs.columns
        assert Counter(map(str, many.collect())) == Counter(map(str, decontaminate.decontaminate(docs, bench, remove=remove).collect()))


def test_pipeline_keeps_its_files(tmp_path):
    """A second session reads what the first one wrote, after it has ended."""
    import subprocess
    import sys

    data, shared, out = tmp_path / "data", tmp_path / "shared", tmp_path / "corpus"
    code = """
import sys
from pyspark.sql import SparkSession
import corpus_pipeline
from arborlake.llm import token_output
step, data, shared, out = sys.argv[1:]
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", shared).getOrCreate()
if step == "write":
    rows = [(i, f"text number {i} of some words " * (i % 5), "en", "src1", 0) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{data}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{data}/labels.parquet")
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{data}/benchmark.parquet")
    got = corpus_pipeline.run(spark, data, None if out == "default" else out).collect()
else:
    manifest = spark.read.parquet(f"{out}/manifest")
    got = token_output.read(manifest, out).collect()
print("DIGEST", *sorted({getattr(r, "folder", out) for r in got}), sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in got), sep="|")
"""
    say = lambda *args: next(x for x in subprocess.run([sys.executable, "-c", code, *map(str, args)], capture_output=True, text=True, check=True).stdout.splitlines() if x.startswith("DIGEST")).split("|")
    _, folder, rows = say("write", f"file://{data}", f"file://{shared}", f"file://{out}")
    assert folder == f"file://{out}" and len(rows) > 20
    assert say("read", f"file://{data}", f"file://{shared}", folder)[2] == rows
    _, folder, rows = say("write", f"file://{data}2", f"file://{shared}", "default")
    assert folder.startswith(f"file://{shared}/") and say("read", f"file://{data}2", f"file://{shared}", folder)[2] == rows
