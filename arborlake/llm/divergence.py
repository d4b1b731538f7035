"""Operator 11: how the sources of a language differ in their words, by inclusion and exclusion over supports.

A term is a run of letters (A-Z and a-z as one) and non-ASCII characters. A language keeps the terms that at least
``least`` of its documents have. Each group (language, source) gives a kept term the smoothed share
p = 1 + floor(10^9 (count + 5) / (N + 5 V)), which depends on its count alone; p0 is that of a count of zero.

The distance of two groups is the sum of abs(p - q) over all kept terms, most of which one or both of them don't
have. So it isn't summed over terms but put together from

* a histogram of counts of each group against p0 of the other, as if no term were in both,
* a constant, abs(p0 - q0), for each term that is in neither, V - |A| - |B| + |A and B| of them,
* and, for terms in both, found by joining the postings (term, group) with each other, what they have
  in excess of the first two.

Texts are read once, whole, and each task sends the counts of its (language, source, term); no text, and no row for
each word, is shuffled. Postings then have one row a term and group however often a term occurs, so
the longest list is one of a language's sources, which the result has all pairs of anyway; the pairs of a term are added up where they
are made. Everything is exact: integers of 64 bits, and decimals for the products.

Nulls: null texts, languages and sources count as ''. A group without terms takes part, with N = 0; a language
without kept terms gives values of 0 and no part ``term``. Repeated rows are documents each. Terms tie by their UTF-8
bytes. An empty table gives no rows. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch

LEAST, TOP, UNIT, SMOOTH = 30, 50, 1_000_000_000, 5
#: Bytes of text cut into terms at once / counts, and bytes of texts they come from, that a task holds before it sends them.
PIECE, HELD, HELD_BYTES = 1 << 20, 1 << 18, 1 << 26
#: Bytes that end a term become spaces, A-Z become a-z.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
COUNTS = "lang string, source string, term string, n long, docs long"


def pieces(text: bytes):
    """The text in parts of about ``PIECE`` bytes that end between terms, as terms with spaces between them."""
    at = 0
    while at < len(text):
        stop, part = at + PIECE, text[at : at + PIECE].translate(_TERMS)
        while stop < len(text) and not part.endswith(b" "):
            more = text[stop : stop + PIECE].translate(_TERMS)
            cut = more.find(b" ") + 1 or len(more)
            part, stop = part + more[:cut], stop + cut
        yield part
        at = stop


def term_counts(docs: DataFrame) -> DataFrame:
    """Partial counts (lang, source, term, n occurrences, docs with it); the term '' counts the documents of a group."""

    def run(batches):
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = read = 0

        def send():
            for (lang, source), (n, with_it) in counts.items():
                terms = list(with_it)
                columns = [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array([n[t] for t in terms], pa.int64()), pa.array(list(with_it.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                n, with_it = counts.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(with_it), Counter()
                for part in pieces(text.as_buffer().to_pybytes()):
                    own.update(part.split())
                n.update(own)
                with_it.update(own.keys())
                with_it[b""] += 1
                held, read = held + len(with_it) - before, read + len(text.as_buffer())
                if held >= HELD or read >= HELD_BYTES:
                    yield from send()
                    counts.clear()
                    held = read = 0
        yield from send()

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(text("lang"), text("source"), text("text")).mapInArrow(run, COUNTS)


def _share(n: str, total: str, terms: str) -> str:
    """SQL of the smoothed share; 0 where no term is kept."""
    return f"CASE WHEN {terms} > 0 THEN 1 + ((CAST({UNIT} AS DECIMAL(10,0)) * CAST({n} + {SMOOTH} AS DECIMAL(20,0))) div CAST({total} + {SMOOTH} * {terms} AS DECIMAL(20,0))) ELSE 0 END"


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Parts ``pair`` and ``term``: lang, source, part, item, value, rank."""
    scratch = Scratch(docs.sparkSession, "divergence")
    counts = term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    everywhere = Window.partitionBy("lang", "term")
    counts = counts.withColumn("all_docs", F.sum("docs").over(everywhere)).withColumn("all_n", F.sum("n").over(everywhere))
    counts = scratch.keep(counts.where(f"term = '' OR all_docs >= {least}").drop("docs", "all_docs"), "counts")
    terms = counts.where("term <> ''")

    langs = terms.groupBy("lang").agg(F.count_distinct("term").alias("v"), F.sum("n").alias("lang_total"))
    own = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("support"))
    groups = counts.where("term = ''").select("lang", "source").join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    groups = scratch.keep(groups.withColumn("p0", F.expr(_share("0", "total", "v"))), "groups")
    priced = terms.join(groups.select("lang", "source", "total", "v", "p0", "lang_total"), ["lang", "source"])
    priced = scratch.keep(priced.select("lang", "source", "term", "p0", F.expr(_share("n", "total", "v")).alias("p"), F.expr(_share("all_n", "lang_total", "v")).alias("q")), "postings")

    a, b = (groups.select("lang", F.col("source").alias(x), F.col("support").alias(f"n{x}"), F.col("p0").alias(f"p{x}"), F.col("v").alias(f"v{x}")) for x in "ab")
    neither = a.join(b, "lang").where("a < b").select("lang", "a", "b", F.expr("(va - na - nb) * abs(pa - pb)").alias("value"))
    # a group's histogram: how many terms have which share
    histogram = priced.groupBy("lang", "source", "p").agg(F.count("*").alias("k"))
    other = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    one_sided = histogram.join(other, "lang").where("source <> other").select("lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"), F.expr("k * abs(p - q0)").alias("value"))
    a, b = (priced.select("lang", "term", F.col("source").alias(x), F.col("p").alias(f"p{x}"), F.col("p0").alias(f"z{x}")) for x in "ab")
    overlap = a.join(b, ["lang", "term"]).where("a < b").select("lang", "a", "b", F.expr("abs(pa - pb) - abs(pa - zb) - abs(pb - za) + abs(za - zb)").alias("value"))
    # each is added up by itself, so that the pairs of terms are before they are shuffled
    parts = [x.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")) for x in (one_sided, overlap)]
    pairs = neither.unionByName(parts[0]).unionByName(parts[1]).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = pairs.select("lang", "value", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x")).select("lang", "x.source", "x.item", "value")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = both.withColumn("rank", F.row_number().over(order))
    term = priced.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    term = term.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pair.withColumn("part", F.lit("pair")).select(columns).unionByName(term.withColumn("part", F.lit("term")).select(columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
