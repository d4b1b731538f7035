"""Medians of the ways between all pairs of contacts on a tree, without the pairs.

Two contacts are as far apart as both are from the root, less twice the way of their lowest common ancestor. At each ancestor the contacts below lie in order of
their way, so how many pairs that meet there are within a distance follows from a search for each contact. The median is closed in on by such counts, and only the
pairs in the last narrow stretch are made.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .trees import ancestors, cut, depths, spread

#: Stretches that a pass cuts the last one into, and pairs of a group that may be made.
STEPS, FEW = 16, 100_000


def _searches():
    """What tasks do with the contacts at a node: counts of the pairs that meet there within bounds, and the ways of the pairs between two bounds."""

    def reached(d: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For each bound and each i: up to where the j > i go whose d, at most, adds up to the bound with that of i. d is in order."""
        return np.maximum(np.searchsorted(d, bounds[:, None] - d, side="right"), np.arange(1, len(d) + 1))

    def within(d: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        lines = bounds[:, None] if len(d) > 1 << 16 else [bounds]
        return np.concatenate([(reached(d, b) - np.arange(1, len(d) + 1)).sum(axis=1) for b in lines])

    @F.pandas_udf("array<long>")
    def counts(d: pd.Series, child: pd.Series, at: pd.Series, twice: pd.Series, bounds: pd.Series) -> pd.Series:
        out = []
        for way, below, own, shift, bound in zip(d, child, at, twice, bounds):
            bound = bound + shift
            n = within(way, bound)
            # pairs below one child meet further down
            order = np.argsort(below, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(below[order])) + 1):
                if len(part) > 1 and below[part[0]] != own:
                    n = n - within(way[part], bound)
            out.append(n)
        return pd.Series(out)

    @F.pandas_udf("array<double>")
    def between(d: pd.Series, child: pd.Series, at: pd.Series, twice: pd.Series, low: pd.Series, high: pd.Series) -> pd.Series:
        out = []
        for way, below, own, shift, *bounds in zip(d, child, at, twice, low, high):
            start, stop = reached(way, np.array(bounds) + shift)
            found = []
            # parts of about a million pairs
            for rows in np.split(np.arange(len(way)), np.flatnonzero(np.diff(np.cumsum(stop - start) >> 20)) + 1):
                n = (stop - start)[rows]
                i = np.repeat(rows, n)
                j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[rows], n)
                meets = (below[i] != below[j]) | (below[i] == own)
                found.append(way[i[meets]] + way[j[meets]] - shift)
            out.append(np.concatenate(found))
        return pd.Series(out)

    return counts, between


def _lists(nodes: DataFrame, contacts: DataFrame) -> DataFrame:
    """(grp, at, twice, d, child): of each group and node at which pairs of contacts may meet: twice its way from the root, and of the contacts below, in order, their ways and the child above them (a contact at the node itself has that)."""
    depth = cut(depths(nodes).select("node_id", "distance"))
    own = contacts.select("grp", "node_id").where("grp IS NOT NULL").join(spread(depth), "node_id")
    ids = own.select("node_id").distinct()
    up = nodes.where("parent_id IS NOT NULL").select(F.col("node_id").alias("child"), F.col("parent_id").alias("at"))
    way = ancestors(nodes, ids).select("node_id", F.col("ancestor").alias("child")).join(spread(up), "child").select("node_id", "child", "at")
    way = way.unionByName(ids.select("node_id", F.col("node_id").alias("child"), F.col("node_id").alias("at")))
    rows = own.join(spread(way), "node_id").groupBy("grp", "at").agg(F.sort_array(F.collect_list(F.struct(F.col("distance").alias("d"), "child"))).alias("c"), F.min("child").alias("first"), F.max("child").alias("last"))
    rows = rows.where("size(c) > 1 AND (first <> last OR first = at)").join(spread(depth.withColumnRenamed("node_id", "at")), "at")
    return cut(rows.select("grp", "at", (2 * F.col("distance")).alias("twice"), "c.d", "c.child"))


def median_distances(nodes: DataFrame, contacts: DataFrame, few: int = FEW) -> DataFrame:
    """(grp, d): the median way between the pairs of contacts (grp, node_id) of each group that has any; pairs in different trees don't count.

    The rows are those of the contacts' ways up. A pass cuts the stretch that holds a group's median into 16, until ``few`` pairs are left in it or
    all left in it are alike.
    """
    lists = _lists(nodes, contacts)
    counts, between = _searches()
    bounds = lambda column: counts("d", "child", "at", "twice", column)
    every = lists.groupBy("grp").agg(F.sum(bounds(F.array(F.lit(float("inf"))))[0]).alias("k"), (F.max(F.element_at("d", -1)) * 2 + 1).alias("high")).where("k > 0")
    rank = F.explode(F.array_distinct(F.array(F.expr("(k + 1) div 2"), F.expr("k div 2 + 1")))).alias("rank")
    # of each rank: the stretch it is in, how many pairs come before that and how many are in it
    state = cut(every.select("grp", rank, F.lit(-1.0).alias("low"), "high", F.lit(0).cast("long").alias("before"), "k"))
    is_open = (F.col("k") > few) & (F.col("high") - F.col("low") > 1e-13 * F.col("high"))
    while not state.where(is_open).isEmpty():
        step = F.transform(F.sequence(F.lit(1), F.lit(STEPS - 1)), lambda i: F.col("low") + (F.col("high") - F.col("low")) * i / STEPS)
        asks = state.where(is_open).select("grp", "low", "high").distinct().withColumn("steps", step)
        each = lists.join(asks, "grp").select("grp", "low", "high", "steps", F.posexplode(bounds(F.col("steps"))).alias("i", "n"))
        each = each.groupBy("grp", "low", "high", "steps", "i").agg(F.sum("n").alias("n")).groupBy("grp", "low", "high", "steps").agg(F.sort_array(F.collect_list(F.struct("i", "n"))).alias("n"))
        new = state.where(is_open).join(each.select("grp", "low", "high", F.concat(F.array("low"), "steps", F.array("high")).alias("at"), F.col("n.n").alias("n")), ["grp", "low", "high"])
        new = new.withColumn("n", F.concat(F.array("before"), "n", F.array(F.col("before") + F.col("k")))).withColumn("i", F.expr("size(filter(n, x -> x < rank))"))
        new = new.select("grp", "rank", F.expr("at[i - 1]").alias("low"), F.expr("at[i]").alias("high"), F.expr("n[i - 1]").alias("before"), F.expr("n[i] - n[i - 1]").alias("k"))
        state = cut(state.where(~is_open).unionByName(new))
    asks = state.where(F.col("k") <= few).select("grp", "low", "high").distinct()
    left = lists.join(asks, "grp").select("grp", "low", "high", F.explode(between("d", "child", "at", "twice", "low", "high")).alias("d"))
    left = left.withColumn("place", F.row_number().over(Window.partitionBy("grp", "low", "high").orderBy("d")))
    found = state.where(F.col("k") <= few).withColumn("place", F.col("rank") - F.col("before")).join(left, ["grp", "low", "high", "place"]).select("grp", "d")
    return found.unionByName(state.where(F.col("k") > few).select("grp", F.col("high").alias("d"))).groupBy("grp").agg(F.avg("d").alias("d"))
