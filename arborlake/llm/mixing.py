"""Operator 4: mixing sources to target weights over a domain - language - source tree.

Every node's capacity is the tokens below it times the number of epochs allowed. The
total is divided top down. Among siblings each gets its share by weight, but no more
than its capacity; what one can't take goes to its siblings by their weights, and only
what all siblings together can't take was already withheld by their parent, whose
capacity counts it: siblings make up for a shortage before ancestors do.
Shares are integers, exact in decimal arithmetic and rounded down.

A leaf then takes a prefix of its tokens from seeded epochs. In each epoch its documents
stand in an order given by a hash of seed, epoch and id; whole documents are taken while
the budget lasts, that is, while the tokens before a document are less than the budget.
To place the budget's end, a leaf's documents are first counted by the first digits of their
hash, in ``BIN`` bins, then those of the one bin where the budget ends by the digits that
follow. Only the documents of the bin of a bin that is left are sorted: of ten billion
documents of a leaf, about 600. So no leaf is sorted or gathered in one task.

Nulls: a null domain, language or source is a value of its own, "". A null text has no
tokens and, like every document without tokens, is never selected. Ties in the order are
broken by id; equal rows and rows of one id are taken together. A weight that isn't
listed is ``other_weight``. An empty table gives no rows. A text of any length is one document
and taken whole. Extra columns are kept, and may have any names but those that begin with ``__mix_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch

#: Bins of a level, and levels: a leaf's documents are split into 4096 bins, and one of them again.
BIN, LEVELS = 4096, 2
#: A token: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Tokens of a text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def domain(source: Column) -> Column:
    """The domain of a source by its number: web, reference or community."""
    n = F.coalesce(F.expr("try_cast(regexp_extract(source, '[0-9]+$', 0) AS INT)"), F.lit(0))
    return F.when(n == 0, "web").when(n < 10, "reference").otherwise("community")


def divide(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Budgets of siblings: ``nodes`` has the columns ``parent``, weight, capacity and pool (the parent's budget)."""
    ratio = Window.partitionBy(*parent).orderBy(F.col("capacity").cast("double") / F.col("weight"), *[c for c in nodes.columns if c not in (*parent, "capacity", "weight", "pool")])
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = nodes.withColumn("__mix_used", F.coalesce(F.sum("capacity").over(before), F.lit(0)).cast("decimal(19,0)"))
    out = out.withColumn("__mix_rest", F.sum("weight").over(after).cast("decimal(10,0)"))
    share = F.expr("CAST(CAST(weight AS DECIMAL(10,0)) * CAST(pool - __mix_used AS DECIMAL(19,0)) AS DECIMAL(29,0))")
    out = out.withColumn("__mix_full", F.expr("CAST(CAST(capacity AS DECIMAL(19,0)) * __mix_rest AS DECIMAL(29,0))") <= share)
    # the first that isn't full sets the level for all after it
    level = Window.partitionBy(*parent)
    out = out.withColumn("__mix_u", F.min(F.when(~F.col("__mix_full"), F.col("__mix_used"))).over(level)).withColumn("__mix_w", F.max(F.when(~F.col("__mix_full"), F.col("__mix_rest"))).over(level))
    even = F.expr("CAST(CAST(weight AS DECIMAL(10,0)) * CAST(pool - __mix_u AS DECIMAL(19,0)) AS DECIMAL(29,0)) div __mix_w")
    return out.withColumn("budget", F.when(F.col("__mix_full"), F.col("capacity")).otherwise(even).cast("long")).drop("__mix_used", "__mix_rest", "__mix_full", "__mix_u", "__mix_w")


def budgets(leaves: DataFrame, weights: dict[str, dict], total: int, epochs: int, other_weight: int = 1) -> DataFrame:
    """(domain, lang, source, tokens, budget) for leaves (domain, lang, source, tokens)."""

    def weight(level: str, column: str) -> Column:
        out = F.lit(other_weight)
        for name, w in weights.get(level, {}).items():
            out = F.when(F.col(column) == name, w).otherwise(out)
        return out.cast("long")

    leaves = leaves.where("tokens > 0").withColumn("capacity", F.col("tokens") * epochs)
    langs = leaves.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity"))
    domains = langs.groupBy("domain").agg(F.sum("capacity").alias("capacity"))
    root = domains.withColumn("root", F.lit(0)).withColumn("weight", weight("domain", "domain"))
    root = root.withColumn("pool", F.least(F.lit(total).cast("long"), F.sum("capacity").over(Window.partitionBy("root"))))
    top = divide(root, ["root"]).select("domain", F.col("budget").alias("pool"))
    mid = divide(langs.join(top, "domain").withColumn("weight", weight("lang", "lang")), ["domain"]).select("domain", "lang", F.col("budget").alias("pool"))
    low = divide(leaves.join(mid, ["domain", "lang"]).withColumn("weight", weight("source", "source")), ["domain", "lang"])
    return low.select("domain", "lang", "source", "tokens", "budget")


def mix(docs: DataFrame, weights: dict[str, dict], fraction: float = 1.0, epochs: int = 2, seed: int = 17) -> DataFrame:
    """Selected rows of ``docs``, once per epoch that takes them, with ``__mix_`` columns: epoch, tokens, domain, before, budget.

    ``fraction`` of all tokens is the total to divide; ``epochs`` is how often a token may be used.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    leaf = ["__mix_domain", "__mix_lang", "__mix_source"]
    base = docs.withColumn("__mix_lang", F.coalesce(F.col("lang").cast("string"), F.lit(""))).withColumn("__mix_source", F.coalesce(F.col("source").cast("string"), F.lit(""))).withColumn("__mix_domain", domain(F.col("source"))).withColumn("__mix_tokens", words(F.col("text").cast("string")))
    base = base.withColumn("__mix_key", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    # what decides is small: one row a document without its text
    slim = scratch.keep(base.select(*leaf, "__mix_tokens", "__mix_key"), "tokens").where("__mix_tokens > 0")
    leaves = slim.groupBy(*leaf).agg(F.sum("__mix_tokens").alias("tokens")).toDF("domain", "lang", "source", "tokens")
    leaves = scratch.keep(leaves, "leaves")
    whole = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    given = scratch.keep(budgets(leaves, weights, int(whole * fraction), epochs), "budgets")
    budget = given.select(F.col("domain").alias(leaf[0]), F.col("lang").alias(leaf[1]), F.col("source").alias(leaf[2]), F.col("tokens").alias("__mix_leaf"), F.col("budget").alias("__mix_budget"))

    def placed(df: DataFrame) -> DataFrame:
        """Every document in every epoch that its leaf's budget reaches, with its hash and its bin of each level."""
        out = df.join(budget, leaf).where("__mix_budget > 0")
        out = out.withColumn("__mix_epoch", F.explode(F.expr("sequence(0L, (__mix_budget - 1) div __mix_leaf)")))
        out = out.withColumn("__mix_hash", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__mix_epoch").cast("string"), F.col("__mix_key"))))
        left = F.conv(F.substring("__mix_hash", 1, 8), 16, 10).cast("long") * BIN
        for i in range(LEVELS):
            out = out.withColumn(f"__mix_bin{i}", F.floor(left / F.lit(1 << 32)))
            left = (left % F.lit(1 << 32)) * BIN
        return out

    slim = placed(slim)
    # per level, the bin of each leaf where the budget ends, and the tokens before it
    known = [*leaf, "__mix_epoch"]
    end, begin = None, F.col("__mix_epoch") * F.col("__mix_leaf")
    for i in range(LEVELS):
        within = slim if end is None else slim.join(end, known)
        first = [] if end is None else [F.first("__mix_first").alias("__mix_from")]
        binned = within.groupBy(*known, f"__mix_bin{i}").agg(F.sum("__mix_tokens").alias("__mix_sum"), F.first("__mix_budget").alias("__mix_budget"), F.first("__mix_leaf").alias("__mix_leaf"), *first)
        order = Window.partitionBy(*known).orderBy(f"__mix_bin{i}").rowsBetween(Window.unboundedPreceding, -1)
        binned = binned.withColumn("__mix_first", (begin if end is None else F.col("__mix_from")) + F.coalesce(F.sum("__mix_sum").over(order), F.lit(0)))
        known = [*known, f"__mix_bin{i}"]
        end = scratch.keep(binned.where("__mix_first < __mix_budget AND __mix_first + __mix_sum >= __mix_budget").select(*known, "__mix_first"), "ends")
    # in the bin where the budget ends: tokens up to each key
    inner = Window.partitionBy(*leaf).orderBy("__mix_hash", "__mix_key").rowsBetween(Window.unboundedPreceding, -1)
    last = slim.join(end, known).groupBy(*leaf, "__mix_epoch", "__mix_hash", "__mix_key").agg(F.sum("__mix_tokens").alias("t"), F.first("__mix_first").alias("__mix_first"), F.first("__mix_budget").alias("__mix_budget"))
    last = last.withColumn("before", F.col("__mix_first") + F.coalesce(F.sum("t").over(inner), F.lit(0))).where("before < __mix_budget")
    cut = scratch.keep(last.groupBy(*leaf).agg(F.max(F.struct("__mix_epoch", "__mix_hash", "__mix_key")).alias("__mix_cut")), "cuts")

    scratch.only(given, cut)
    # the tokens themselves aren't needed again: a filter on them would count them twice
    out = placed(base.where(F.coalesce(F.col("text").cast("string").rlike(WORD), F.lit(False)))).join(cut, leaf)
    taken = F.struct("__mix_epoch", "__mix_hash", "__mix_key") <= F.col("__mix_cut")
    return out.where(taken).drop("__mix_cut", "__mix_hash", *[f"__mix_bin{i}" for i in range(LEVELS)], "__mix_leaf", "__mix_key", "__mix_lang", "__mix_source")


#: The production targets: relative weights by level; all else weighs ``other_weight``.
WEIGHTS = {"domain": {"web": 3, "reference": 4, "community": 3}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 2}, "source": {"src3": 2}}


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), WEIGHTS)
    return out.select("doc_id", F.col("__mix_epoch").alias("epoch"), F.col("__mix_domain").alias("domain"), "lang", "source", F.col("__mix_tokens").alias("n_tokens"), F.col("__mix_budget").alias("leaf_budget"))
