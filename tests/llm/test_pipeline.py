"""The pipeline, stage by stage, against brute force on what the stage before kept."""

import random
from collections import Counter

import corpus_pipeline
from arborlake.llm import mixing

from .test_llm import DOCS, WORD, brute_links, brute_mix, brute_windows, union_find


def tables(spark, folder):
    """Clean, toxic, copied, nearly copied and leaked documents; half of the toxic ones are not labelled."""
    r = random.Random(9)
    prose, vile = [f"word{i}" for i in range(400)], [f"vile{i}" for i in range(6)]
    text = lambda n: [r.choice(prose) for _ in range(n)]
    texts = [" ".join(text(r.randint(20, 80))) for _ in range(120)]
    toxic = []
    for _ in range(40):
        words = text(40)
        for _ in range(8):
            words[r.randrange(40)] = r.choice(vile)
        toxic.append(len(texts))
        texts.append(" ".join(words))
    texts += [texts[3], texts[3], texts[4] + " more", None, "", "one two"]
    items = [(f"b{i}", " ".join(text(n))) for i, n in enumerate((30, 12, 10))] + [("none", None)]
    leaked = range(len(texts), len(texts) + 3)
    texts += [" ".join(text(15)) + " " + t.upper() + " " + " ".join(text(15)) for _, t in items[:3]]
    rows = [(i, t, ("en", "de", None)[i % 3], f"src{i % 12}", len(t or "")) for i, t in enumerate(texts)]
    labels = [(i, 1, int(i in toxic)) for i in range(len(texts)) if i not in toxic[20:]]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return toxic, leaked, items


def test_stages(spark, tmp_path):
    folder = f"file://{tmp_path}"
    toxic, leaked, items = tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept, schema = {"": docs.collect()}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/out/{name}")
        docs = spark.read.parquet(f"{folder}/out/{name}")
        assert name == "tokens" or docs.columns == schema
        kept[name] = docs.collect()
    ids = {k: sorted(r["doc_id"] for r in v) for k, v in kept.items()}
    assert ids["toxicity"] == sorted(set(ids[""]) - set(toxic))

    before = sorted(kept["toxicity"], key=lambda r: r["doc_id"])
    root = union_find(range(len(before)), brute_links([r["text"] for r in before], WORD, 5, 80)[1])
    assert ids["minhash"] == [before[i]["doc_id"] for i in sorted(set(root.values()))]
    assert len(ids["minhash"]) == len(before) - 3

    before = sorted(kept["minhash"], key=lambda r: r["doc_id"])
    clean = [r["doc_id"] for r, (_, hit, _) in zip(before, brute_windows([r["text"] for r in before], items)) if not hit]
    assert ids["decontamination"] == clean and not set(clean) & set(leaked)

    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in kept["decontamination"]]
    assert Counter(ids["mixing"]) == Counter(d for d, _ in brute_mix(rows, mixing.WEIGHTS, 1.0, 2, 17))
    assert ids["tokens"] == ids["mixing"]

    whole = corpus_pipeline.run(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, whole.collect())) == sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in kept["tokens"])
