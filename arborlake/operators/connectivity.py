"""Connectivity between neurons, from connectors (connector_id, pre) and links (connector_id, post, confidence).

A weight counts links, not distinct neurons: a neuron hit by several nodes counts each.
Results are long tables; ``wide`` pivots them at the edge.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .trees import cut, spread

#: Targets in a list of ``adjacency``, and pairs that a task unfolds.
LISTED, UNFOLDED = 2048, 1 << 22
#: Links that a task of a join sorts, as a rule.
DEALT = 1 << 19
#: Neurons of a query in a list of a partner's, as a rule, and neurons of which a row each may go to everyone.
TOGETHER, FEW = 256, 1 << 17
METHODS = {"SUM": F.sum, "AVERAGE": F.avg, "MIN": F.min, "MAX": F.max}


def places(spark: SparkSession, n: int) -> int | None:
    """Into how many places ``n`` links are dealt, so that a task's share doesn't grow with them; None where the session's partitions are enough."""
    wanted = -(-n // DEALT)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def dealt(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """The table dealt to so many places by its keys; as it is for None."""
    return df if parts is None else df.repartition(parts, *keys)


def met(x: DataFrame, y: DataFrame, keys: list[str]) -> int:
    """How many rows a join of both on ``keys`` has, from counts; of a key that both have."""
    count = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    return count(x, "n").join(spread(count(y, "m")), keys).agg(F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0))).first()[0]


def few(df: DataFrame, n: int) -> DataFrame:
    """A table of ``n`` rows for a join: sent to everyone if these are few, else dealt, whatever its files weigh."""
    return F.broadcast(df) if n <= FEW else spread(df)


def in_lists(mine: DataFrame, keys: list[str], columns: list[str], own: str, parts: int) -> DataFrame:
    """(keys, salt, near): the rows of each key as lists of structs of ``columns``, ``TOGETHER`` a list as a rule by the column ``own``, each list for every one of ``parts`` salts.

    So a pair of rows of one key costs an entry of a list where it is dealt, not a row.
    """
    m = F.count("*").over(Window.partitionBy(*keys))
    rows = mine.withColumn("__list", F.pmod(F.xxhash64(own), F.ceil(m / TOGETHER)))
    lists = rows.groupBy(*keys, "__list").agg(F.collect_list(F.struct(*columns)).alias("near"))
    return lists.select(*keys, "near", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("salt"))


def _linked(connectors: DataFrame, links: DataFrame, parts: int | None) -> DataFrame:
    if parts is None:
        return connectors.join(links, "connector_id")
    return dealt(connectors, parts, "connector_id").join(spread(dealt(links, parts, "connector_id")), "connector_id")


def edges(connectors: DataFrame, links: DataFrame, min_confidence: int | None = None, parts: int | None = None) -> DataFrame:
    """source, target, weight. A least confidence of None, 0 or 1 means all links; ``parts`` are the places that links and edges are dealt to (see ``places``)."""
    if min_confidence and min_confidence > 1:
        links = links.where(F.col("confidence") >= min_confidence)
    pairs = _linked(connectors, links, parts).select(F.col("pre").alias("source"), F.col("post").alias("target"))
    return dealt(pairs, parts, "source", "target").groupBy("source", "target").agg(F.count("*").alias("weight"))


def connector_details(connectors: DataFrame, links: DataFrame) -> DataFrame:
    """Per connector: its presynaptic neuron, the distinct postsynaptic neurons and the number of links; without links an empty list."""
    post = links.groupBy("connector_id").agg(F.array_sort(F.collect_set("post")).alias("postsynaptic_to"), F.count("*").alias("n_links"))
    out = connectors.select("connector_id", F.col("pre").alias("presynaptic_to")).join(post, "connector_id", "left")
    return out.withColumns({"postsynaptic_to": F.coalesce("postsynaptic_to", F.array().cast("array<bigint>")), "n_links": F.coalesce("n_links", F.lit(0)).cast("long")})


def connectors_between(connectors: DataFrame, links: DataFrame, a: DataFrame, b: DataFrame, directional: bool = True) -> DataFrame:
    """Links from the neurons ``a`` (id) onto the neurons ``b`` (id); with ``directional=False`` also the reverse ones."""
    full = connectors.join(links, "connector_id").select("connector_id", F.col("pre").alias("source"), F.col("post").alias("target"), "confidence")

    def one_way(x: DataFrame, y: DataFrame) -> DataFrame:
        return full.join(x.select(F.col("id").alias("source")).distinct(), "source", "left_semi").join(y.select(F.col("id").alias("target")).distinct(), "target", "left_semi")

    out = one_way(a, b)
    return (out if directional else out.unionByName(one_way(b, a))).select("connector_id", "source", "target", "confidence")


def adjacency(edge_table: DataFrame, sources: DataFrame, targets: DataFrame, syn_threshold: int | None = None, syn_cutoff: int | None = None, fractions: bool = False, inputs: DataFrame | None = None) -> DataFrame:
    """Every pair of ``sources`` (id) and ``targets`` (id) with its weight, 0 where there is no edge.

    Weights above the cutoff are clipped to it, those below the threshold become 0. With
    ``fractions`` they are divided by all the target's inputs; no input gives null. The
    grid is asked for by the caller; ``edges`` itself never builds it.
    """

    def shown(w: Column) -> Column:
        if syn_cutoff is not None:
            w = F.least(w, F.lit(float(syn_cutoff)))
        return F.when(w < syn_threshold, 0.0).otherwise(w) if syn_threshold is not None else w

    s, t = sources.select(F.col("id").alias("source")).distinct(), targets.select(F.col("id").alias("target")).distinct()
    own = edge_table.join(s, "source", "left_semi").join(t, "target", "left_semi").select("source", "target", shown(F.coalesce(F.col("weight").cast("double"), F.lit(0.0))).alias("weight"))
    t = t.withColumn("none", shown(F.lit(0.0)))  # what is shown for a source without an edge
    if fractions:
        total = (inputs if inputs is not None else edge_table).groupBy("target").agg(F.sum("weight").cast("double").alias("total"))
        part = F.try_divide("weight", "total").alias("weight")
        t = t.join(total, "target", "left").select("target", F.try_divide("none", "total").alias("none"))
        own = own.join(total, "target", "left").select("source", "target", part)
    own, t = cut(own), cut(t)
    # the rest of the grid is never shuffled: lists of targets meet each source, less those that it has edges to, and are unfolded where they are
    n = t.count()
    parts = max(1, -(-n // LISTED))
    place = F.pmod(F.xxhash64("target"), F.lit(parts)).alias("place")
    lists = t.groupBy(place, "none").agg(F.collect_list(F.struct("target"))["target"].alias("every"))
    has = own.groupBy("source", place).agg(F.collect_list("target").alias("has"))
    rows = s.withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))).join(has, ["source", "place"], "left")
    rows = rows.repartition(max(1, -(-s.count() * n // UNFOLDED)))  # small rows yet, but what they unfold to is dealt evenly
    rest = rows.join(F.broadcast(lists), "place")  # as long as the targets, LISTED of them a row
    rest = rest.select("source", F.explode(F.when(F.col("has").isNull(), F.col("every")).otherwise(F.array_except("every", "has"))).alias("target"), F.col("none").alias("weight"))
    return own.unionByName(rest)


def group_matrix(matrix: DataFrame, row_groups: DataFrame | None = None, col_groups: DataFrame | None = None, method: str = "SUM", drop_ungrouped: bool = False) -> DataFrame:
    """Collapse a long matrix (source, target, weight), rows first and columns then, so AVERAGE is a mean of means. Groups: (id, grp).

    For the other methods the order makes no difference, and one aggregation serves both.
    """
    both = method != "AVERAGE" and row_groups is not None and col_groups is not None
    for groups, own, other in ((row_groups, "source", "target"), (col_groups, "target", "source")):
        if groups is None:
            continue
        matrix = matrix.join(groups.select(F.col("id").alias(own), "grp"), own, "inner" if drop_ungrouped else "left")
        label = F.coalesce(F.col("grp").cast("string"), F.col(own).cast("string"))
        if both:
            matrix = matrix.select(label.alias(own), other, "weight")
        else:
            matrix = matrix.groupBy(label.alias(own), other).agg(METHODS[method]("weight").alias("weight"))
    return matrix.groupBy("source", "target").agg(METHODS[method]("weight").alias("weight")) if both else matrix


def partners(edge_table: DataFrame, query: DataFrame, sizes: DataFrame, threshold: int = 1, min_size: int = 2) -> DataFrame:
    """Long partner table of the neurons ``query`` (id): relation, partner, query neuron, weight, total over the query. sizes: (id, num_nodes)."""
    q = query.select("id").distinct()
    down = edge_table.join(q, F.col("source") == F.col("id"), "left_semi").select(F.lit("downstream").alias("relation"), F.col("target").alias("partner"), F.col("source").alias("query"), "weight")
    up = edge_table.join(q, F.col("target") == F.col("id"), "left_semi").select(F.lit("upstream").alias("relation"), F.col("source").alias("partner"), F.col("target").alias("query"), "weight")
    both = down.unionByName(up)
    total = both.groupBy("relation", "partner").agg(F.sum("weight").alias("total")).where(F.col("total") >= threshold)
    size = sizes.select(F.col("id").alias("partner"), "num_nodes").where(F.col("num_nodes") >= min_size)
    return both.join(total.join(size, "partner"), ["relation", "partner"]).select("relation", "partner", "num_nodes", "query", "weight", "total")


def wide(long: DataFrame, keys: list[str], column: str, ids: list, value: str = "weight") -> DataFrame:
    """One column for each of the given ids."""
    return long.groupBy(*keys).pivot(column, ids).agg(F.sum(value)).na.fill(0, [str(i) for i in ids])


def shared_partners(edge_table: DataFrame, a: DataFrame, b: DataFrame, syn_threshold: int = 1) -> DataFrame:
    """Partners of both groups (id), per relation, whose weight with each reaches the threshold."""
    both = a.select("id", F.lit("a").alias("side")).unionByName(b.select("id", F.lit("b").alias("side"))).distinct()
    down = edge_table.join(both, F.col("source") == F.col("id")).select(F.lit("downstream").alias("relation"), F.col("target").alias("partner"), "side", "weight")
    up = edge_table.join(both, F.col("target") == F.col("id")).select(F.lit("upstream").alias("relation"), F.col("source").alias("partner"), "side", "weight")
    sums = [F.sum(F.when(F.col("side") == s, F.col("weight")).otherwise(0)).alias(f"weight_{s}") for s in "ab"]
    return down.unionByName(up).groupBy("relation", "partner").agg(*sums).where((F.col("weight_a") >= syn_threshold) & (F.col("weight_b") >= syn_threshold))


def connectivity_counts(connectors: DataFrame, links: DataFrame, count_links: bool = True, parts: int | None = None) -> DataFrame:
    """Per neuron and relation: its links, or its distinct connectors. ``parts``: see ``edges``."""
    full = _linked(connectors, links, parts)
    pre = full.select(F.col("pre").alias("id"), F.lit("presynaptic_to").alias("relation"), "connector_id")
    post = full.select(F.col("post").alias("id"), F.lit("postsynaptic_to").alias("relation"), "connector_id")
    return pre.unionByName(post).groupBy("id", "relation").agg((F.count("*") if count_links else F.count_distinct("connector_id")).alias("count"))


def _whole_kurtosis(value: Column) -> Column:
    """Excess kurtosis of whole numbers from exact sums of their powers, with one rounding at the end; null where the values don't differ or the numbers get too large."""
    times = lambda *x: reduce(F.try_multiply, [F.lit(i).cast("decimal(38,0)") if isinstance(i, int) else i for i in x])
    one = value.cast("decimal(19,0)").cast("decimal(38,0)")
    n = F.count(value).cast("decimal(38,0)")
    a, b, c, d = (F.try_sum(times(*[one] * k)) for k in (1, 2, 3, 4))
    spread = F.try_subtract(times(n, b), times(a, a))
    fourth = F.try_subtract(F.try_add(times(n, n, n, d), times(6, n, a, a, b)), F.try_add(times(4, n, n, a, c), times(3, a, a, a, a)))
    # both are the central moments times the fourth power of n
    over = F.try_subtract(fourth, times(3, spread, spread))
    return F.try_divide(over.cast("double"), times(spread, spread).cast("double"))


def sparseness(matrix: DataFrame, key: str = "target", value: str = "weight", which: str = "LTS") -> DataFrame:
    """Lifetime sparseness or kurtosis of each key's values; nulls don't count."""
    v = F.col(value).cast("double")
    if which == "LTK":
        whole = dict(matrix.dtypes)[value] in ("tinyint", "smallint", "int", "bigint")
        score: Column = F.coalesce(_whole_kurtosis(F.col(value)), F.kurtosis(v)) if whole else F.kurtosis(v)
    else:
        n = F.count(v).cast("double")
        score = F.try_divide(1 - F.try_divide(F.pow(F.sum(v) / n, F.lit(2)), F.sum(v * v) / n), 1 - 1 / n)
    return matrix.groupBy(key).agg(score.alias("sparseness"))


def sparseness_with_zeros(edge_table: DataFrame, n: int, keys: DataFrame) -> DataFrame:
    """Lifetime sparseness of each of ``keys`` (target) over ``n`` sources, those without an edge as 0: from sums over the edges, without their grid."""
    w = F.col("weight").cast("double")
    sums = edge_table.groupBy("target").agg(F.sum(w).alias("s"), F.sum(w * w).alias("q"))
    score = F.try_divide(1 - F.try_divide(F.pow(F.col("s") / n, F.lit(2)), F.col("q") / n), F.lit(1 - 1 / n if n > 1 else 0.0))
    return keys.select("target").distinct().join(sums, "target", "left").select("target", score.alias("sparseness"))


def similarity_to(edge_table: DataFrame, query: DataFrame, parts: int = 32) -> DataFrame:
    """(a, b, both, matching_index, matching_index_synapses): each neuron of ``query`` (id) against all neurons with a shared downstream partner.

    The shared partners of the query are looked up in all edges, dealt by partner and source, so a partner of very many neurons is no single task.
    What meets is a list of the query's neurons at a partner; lists are dealt by the other neuron and unfolded where their pairs are summed.
    """
    edges = cut(edge_table.select("source", "target", F.col("weight").cast("double").alias("w")))
    spark, n_edges = edge_table.sparkSession, edges.count()
    total = cut(dealt(edges, places(spark, n_edges), "source").groupBy("source").agg(F.count("*").alias("n"), F.sum("w").alias("sum")))
    ids = cut(query.select(F.col("id").alias("source")).distinct())
    n_ids = ids.count()
    mine = cut(edges.join(few(ids, n_ids), "source", "left_semi").select(F.col("source").alias("a"), "target", F.col("w").alias("wa")))
    # joins and sums are dealt to places that grow with the rows, so that a task's share doesn't
    n = met(mine, edges, ["target"])
    wide_, out_ = places(spark, max(n_edges + parts * mine.count(), n // TOGETHER)), places(spark, n)
    own = in_lists(mine, ["target"], ["a", "wa"], "a", parts)
    every = edges.select(F.col("source").alias("b"), "target", F.col("w").alias("wb"), F.pmod(F.xxhash64("source"), F.lit(parts)).alias("salt"))
    near = dealt(every, wide_, "target", "salt").join(spread(dealt(own, wide_, "target", "salt")), ["target", "salt"]).select("b", "wb", "near")
    # lists are dealt by b and unfolded there, so pairs themselves are never shuffled
    near = near.repartition("b") if out_ is None else near.repartition(out_, "b")
    shared = near.select("b", "wb", F.inline("near")).groupBy("a", "b").agg(F.count("*").alias("both"), (F.sum("wa") + F.sum("wb")).alias("s"))
    of = lambda k: total.select(F.col("source").alias(k), F.col("n").alias(f"n{k}"), F.col("sum").alias(f"s{k}"))
    of_a = of("a").join(few(ids.withColumnRenamed("source", "a"), n_ids), "a", "left_semi")
    out = shared.join(dealt(of("b"), out_, "b").hint("shuffle_hash"), "b").join(few(of_a, n_ids), "a")
    return out.select("a", "b", "both", (F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("matching_index"), (F.col("s") / (F.col("sa") + F.col("sb"))).alias("matching_index_synapses"))


def nth_partners(edge_table: DataFrame, start: DataFrame, hops: int = 1, min_pre: int = 2, min_post: int = 2) -> DataFrame:
    """(id, hop): neurons reached within ``hops`` steps over edges that are strong enough, by their first hop.

    Downstream edges need ``min_post``, upstream ones ``min_pre``; -1 forbids a direction.
    """
    step = []
    if min_post >= 0:
        step.append(edge_table.where(F.col("weight") >= min_post).select(F.col("source").alias("id"), F.col("target").alias("next")))
    if min_pre >= 0:
        step.append(edge_table.where(F.col("weight") >= min_pre).select(F.col("target").alias("id"), F.col("source").alias("next")))
    step = cut(reduce(DataFrame.unionByName, step).distinct())  # not computed again for each hop
    seen = front = start.select("id").distinct().withColumn("hop", F.lit(0))
    for h in range(1, hops + 1):
        front = front.join(step, "id").select(F.col("next").alias("id")).distinct().join(seen.select("id"), "id", "left_anti").withColumn("hop", F.lit(h))
        front = cut(front)
        seen = seen.unionByName(front)
    return seen


def paths(edge_table: DataFrame, sources: DataFrame, targets: DataFrame, n_hops: list[int], min_synapses: int = 1) -> DataFrame:
    """(path, hops): simple paths from sources to targets with just so many hops. Steps from which no target can be reached any more in time aren't taken."""
    most = max(n_hops)
    step = cut(edge_table.where(F.col("weight") >= min_synapses).select(F.col("source").alias("last"), F.col("target").alias("next")).distinct())
    goal = targets.select(F.col("id").alias("last")).distinct()
    # near[k]: neurons with a target within k hops
    near = [cut(goal)]
    for _ in range(most - 1):
        before = step.join(near[-1].select(F.col("last").alias("next")), "next", "left_semi").select("last")
        near.append(cut(near[-1].unionByName(before).distinct()))
    now = sources.select(F.col("id").alias("last"), F.array("id").alias("path")).distinct()
    found = []
    for h in range(1, most + 1):
        useful = step.join(near[most - h].select(F.col("last").alias("next")), "next", "left_semi")
        now = now.join(useful, "last").where(~F.array_contains("path", F.col("next"))).select(F.col("next").alias("last"), F.array_append("path", F.col("next")).alias("path"))
        now = cut(now)
        if h in n_hops:
            found.append(now.join(goal, "last", "left_semi").select("path", F.lit(h).alias("hops")))
    return reduce(DataFrame.unionByName, found)


def filter_connectors(connectors: DataFrame, restrict_to: DataFrame) -> DataFrame:
    """Connectors (with any columns) whose id is in ``restrict_to``; edges from them are the filtered connectivity."""
    return connectors.join(restrict_to.select("connector_id").distinct(), "connector_id", "left_semi")


def similarity(edge_table: DataFrame, ids: DataFrame, c1: float = 0.5, c2: float = 1.0) -> DataFrame:
    """Five similarities of every pair of the neurons ``ids`` (id) by their downstream partners.

    Partner-keyed: only shared partners meet in a join; what partners of one side
    contribute follows from each neuron's totals. The rows for pairs without shared
    partners come from the grid of the given ids.
    """
    own = cut(edge_table.join(ids.select(F.col("id").alias("source")).distinct(), "source", "left_semi").select("source", "target", F.col("weight").cast("double").alias("w")))
    w = F.col("w")
    total = own.groupBy(F.col("source").alias("id")).agg(F.sum("w").alias("sum"), F.count("*").alias("n"), F.sum(w - c1 * w * F.exp(-c2 * w)).alias("best"))
    x = own.select(F.col("source").alias("a"), "target", F.col("w").alias("wa"))
    y = own.select(F.col("source").alias("b"), "target", F.col("w").alias("wb"))
    low, high = F.least("wa", "wb"), F.greatest("wa", "wb")
    f = lambda lo, hi: lo - c1 * hi * F.exp(-c2 * lo)
    shared = x.join(y, "target").groupBy("a", "b").agg(F.count("*").alias("both"), F.sum("wa").alias("sa"), F.sum("wb").alias("sb"), F.sum(low).alias("min"), F.sum(f(low, high)).alias("score"), F.sum(f(high, high)).alias("top"), F.sum(f(F.col("wa"), F.col("wa"))).alias("ta"), F.sum(f(F.col("wb"), F.col("wb"))).alias("tb"), F.sum(high).alias("max"))
    a, b = (ids.select(F.col("id").alias(k)).distinct() for k in "ab")
    t = lambda k: total.select(F.col("id").alias(k), F.col("sum").alias(f"sum_{k}"), F.col("n").alias(f"n_{k}"), F.col("best").alias(f"best_{k}"))
    grid = a.join(t("a"), "a", "left").join(b.join(t("b"), "b", "left"), F.lit(True)).join(shared, ["a", "b"], "left").na.fill(0)
    n = F.col("n_a") + F.col("n_b") - F.col("both")
    all_w = F.col("sum_a") + F.col("sum_b")
    rest = all_w - F.col("sa") - F.col("sb")
    vertex = F.col("score") - c1 * rest
    most = F.col("top") + F.col("best_a") + F.col("best_b") - F.col("ta") - F.col("tb")
    least = -c1 * (F.col("max") + rest)
    return grid.select(
        "a", "b",
        F.try_divide(F.col("both"), n).alias("matching_index"),
        F.try_divide(F.col("sa") + F.col("sb"), all_w).alias("matching_index_synapses"),
        (F.coalesce(F.try_divide(F.col("sa"), F.col("sum_a")), F.lit(0.0)) * F.coalesce(F.try_divide(F.col("sb"), F.col("sum_b")), F.lit(0.0))).alias("matching_index_weighted_synapses"),
        vertex.alias("vertex"),
        F.try_divide(vertex - least, most - least).alias("vertex_normalized"),
    )
