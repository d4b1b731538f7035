"""Operator 8: URL filters by rules and by trust that spreads over the host graph.

Rules come first: a rule (host and path prefix) fits its host and all subdomains; of
those that fit, the longest decides (of equally long ones, the one whose path, then host is smaller).
Every other page gets the verdict of its host, by personalised PageRank in both directions:

* Seeds are the hosts with pages that rules decide. A host's share of the trust is its
  number of allowed pages, its share of the distrust its number of blocked ones, both over
  all pages that rules decide; so a host with both kinds is a seed of both, by how much.
* Trust walks along links, distrust against them: whoever links to blocked pages is
  distrusted. Edges are host pairs with a count, from links in the pages' html, and from
  each host to its parent domain and back. A relative link stays on its host and moves
  nothing to another one. A host without out-links gives its score back to the seeds.
* A host is blocked when its distrust exceeds ``ratio`` times its trust. Sums of doubles
  depend on their order, so values within ``TIE`` of the larger one are equal, and equal
  ones are allowed. So is a host that no walk reaches: there is nothing against it.

The walk takes as many steps as bring what is left of it, ``damping`` to their number,
below ``tolerance``, so their number depends on no data. To give scores of dead ends back
to the seeds, the walk without that is scaled to the seeds' sum in the end, which is the
same in exact arithmetic.

Pages of one host are aggregated before any shuffle, so the work of a step follows the
number of host pairs. Hosts with very many links or pages are single keys of inner and left joins,
which adaptive execution splits. All of it is DataFrame code, and the rules are literals.

Nulls: a null url, or one without ``://``, has an empty host and path, fits no rule and
is allowed; null html has no links; a null page_id is kept. Repeated pages count again, as links and as
seeds, and have their rows each. Empty tables give no rows. Texts may be of any length; a host of over 127
labels is no domain name and has no parent, but rules fit it like others. Other columns are not read,
whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch

#: (verdict, host, path prefix)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING, TOLERANCE = 0.85, 1e-4
TIE = 1e-9  # far above the rounding of sums, and relative: scores shrink as hosts grow in number
LABELS = 127  # of a domain name, at most
TOGETHER = 8  # steps between two tables that cut lineage


def steps_of(damping: float = DAMPING, tolerance: float = TOLERANCE) -> int:
    """How many steps leave less than ``tolerance`` of the walk."""
    return max(1, math.ceil(math.log(tolerance) / math.log(damping)))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def suffixes(host: Column, most: int = LABELS) -> Column:
    """The host's last labels, up to ``most`` of them: its parent domains, and itself where it has no more."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most))), lambda i: F.array_join(F.slice(labels, F.size(labels) - i + 1, i), "."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, rule_host, rule_path) of literals."""
    kind = "array<struct<verdict:string,rule_host:string,rule_path:string>>"
    rows = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(r, ("verdict", "rule_host", "rule_path"))]) for r in rules]).cast(kind)
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def host_rules(hosts: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, rules): per host the rules of itself and its parents, the longest first."""
    most = max((h.count(".") + 1 for _, h, _ in rules), default=1)
    near = hosts.select("host", F.explode(suffixes(F.col("host"), most)).alias("rule_host")).join(rule_table(hosts.sparkSession, rules), "rule_host")
    rule = F.struct((-F.length("rule_host") - F.length("rule_path")).alias("order"), F.col("rule_path").alias("path"), F.col("rule_host").alias("host"), F.col("verdict"))
    return near.groupBy("host").agg(F.array_sort(F.collect_set(rule)).alias("rules"))


def host_edges(pages: DataFrame, host: Column) -> DataFrame:
    """(src, dst, n) between different hosts."""
    found = F.regexp_extract_all(F.coalesce(F.col("html").cast("string"), F.lit("")), F.lit(r"(?i)(?:href|src)\s*=\s*[\"']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s<>]+)"), F.lit(1))
    links = pages.select(host.alias("src"), F.explode(found).alias("dst")).withColumn("dst", F.translate("dst", UPPER, LOWER))
    return links.where("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("n"))


def family_edges(hosts: DataFrame) -> DataFrame:
    """(src, dst, n): each host and domain with its parent, both ways."""
    domains = hosts.where(F.size(F.split("host", r"\.")) <= LABELS).select(F.explode(suffixes(F.col("host"))).alias("src")).distinct()
    parent = domains.select("src", F.regexp_replace("src", r"^[^.]*\.", "").alias("dst")).where("src <> dst AND dst <> ''")
    return parent.unionByName(parent.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("n", F.lit(1.0))


def spread(edges: DataFrame, seeds: DataFrame, scratch: Scratch, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(side, host, score): personalised PageRank from ``seeds`` (side, host, weight) along ``edges`` (side, src, dst, n); per side the scores sum to what the seeds do."""
    total = edges.groupBy("side", "src").agg(F.sum("n").alias("total"))
    steps = scratch.keep(edges.join(total, ["side", "src"]).select("side", F.col("src").alias("host"), "dst", (F.col("n") / F.col("total")).alias("share")), "steps")
    start = scratch.keep(seeds, "seeds")
    rank = start.select("side", "host", F.col("weight").alias("score"))
    back = start.select("side", "host", (F.col("weight") * (1 - damping)).alias("part"))
    kept, last = None, steps_of(damping, tolerance)
    for i in range(1, last + 1):
        moved = rank.join(steps, ["side", "host"]).select("side", F.col("dst").alias("host"), (F.col("score") * F.col("share") * damping).alias("part"))
        rank = moved.unionByName(back).groupBy("side", "host").agg(F.sum("part").alias("score"))
        if i % TOGETHER == 0 or i == last:
            before, kept = kept, scratch.keep(rank, "rank")
            rank = kept
            if before is not None:
                scratch.drop(before)
    sums = rank.groupBy("side").agg(F.sum("score").alias("now")).join(start.groupBy("side").agg(F.sum("weight").alias("then")), "side")
    # a row a side
    return rank.join(F.broadcast(sums), "side").select("side", "host", (F.col("score") * F.col("then") / F.col("now")).alias("score"))


def exceeds(distrust: Column, bound: Column) -> Column:
    """Whether distrust is above ``bound`` by more than rounding."""
    return distrust - bound > F.lit(TIE) * F.greatest(distrust, bound)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], ratio: float = 1.0, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Per page: page_id, host, path, rule (or null), verdict, and its host's trust and distrust."""
    scratch = Scratch(pages.sparkSession, "url-filter")
    host, path = split_url(F.col("url"))
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    seen = scratch.keep(slim.where("host <> ''").select("host").distinct(), "hosts")
    ruled = scratch.keep(host_rules(seen, rules), "rules")
    fits = F.element_at(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"])), 1)

    def fitted(known: DataFrame) -> DataFrame:
        """Pages with the columns of their host and the rule that decides them."""
        found = F.size(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))) > 0
        return slim.join(known, "host", "left").withColumn("fit", F.when(found, fits))

    decided = fitted(ruled).where("fit IS NOT NULL").groupBy("host").agg(F.count_if(F.col("fit.verdict") == "allow").alias("allow"), F.count_if(F.col("fit.verdict") == "block").alias("block"))
    decided = scratch.keep(decided, "decided")
    whole = decided.agg(F.sum(F.col("allow") + F.col("block"))).first()[0] or 1
    sides = decided.select("host", F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("pages")) for s, c in ((0, "allow"), (1, "block"))])).alias("x")).where("x.pages > 0")
    seeds = sides.select("x.side", "host", (F.col("x.pages") / F.lit(float(whole))).alias("weight"))

    edges = scratch.keep(host_edges(pages, host).unionByName(family_edges(seen)).groupBy("src", "dst").agg(F.sum("n").alias("n")), "edges")
    both = edges.select(F.lit(0).alias("side"), "src", "dst", "n").unionByName(edges.select(F.lit(1).alias("side"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    scores = spread(both, seeds, scratch, damping, tolerance)
    of = lambda s, name: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("score"))), F.lit(0.0)).alias(name)
    known = seen.join(ruled, "host", "left").join(scores.groupBy("host").agg(of(0, "trust"), of(1, "distrust")), "host", "left")
    known = scratch.keep(known.select("host", "rules", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")), "known")
    verdict = F.coalesce(F.col("fit.verdict"), F.when(exceeds(F.col("distrust"), F.lit(float(ratio)) * F.col("trust")), "block").otherwise("allow"))
    return fitted(known).select("page_id", "host", "path", F.concat("fit.host", "fit.path").alias("rule"), verdict.alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), RULES)
    return out.withColumns({c: F.round(c, 9) for c in ("trust", "distrust")})
