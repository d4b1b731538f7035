"""Live versions: activity bins with a watermark, and the edge table kept up to date."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def activity(stream: DataFrame, minutes: int, late: str = "1 hour") -> DataFrame:
    """(user_id, start, n) per time bin; events later than ``late`` are left out. For append or update mode."""
    bins = F.window("ts", f"{minutes} minutes")
    return stream.withWatermark("ts", late).groupBy("user_id", bins.alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def sessions(stream: DataFrame, gap_minutes: int, late: str = "1 hour") -> DataFrame:
    """(user_id, start, stop, n): runs of actions without a longer pause."""
    session = F.session_window("ts", f"{gap_minutes} minutes")
    return stream.withWatermark("ts", late).groupBy("user_id", session.alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "n")


def edges(links: DataFrame) -> DataFrame:
    """Weights of a stream of links (source, target); for complete or update mode."""
    return links.groupBy("source", "target").agg(F.count("*").alias("weight"))


def network_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(source, target, change, weight): new, gone and reweighted edges of two snapshots."""
    b = before.withColumnRenamed("weight", "old")
    out = b.join(after, ["source", "target"], "full")
    change = F.when(F.col("old").isNull(), "new").when(F.col("weight").isNull(), "gone").when(F.col("old") != F.col("weight"), "changed")
    return out.withColumn("change", change).where("change IS NOT NULL").select("source", "target", "change", "weight")


def watch_network(events: DataFrame, least: int = 1) -> DataFrame:
    """(source, target, change, weight) of a stream of links that come and go (source, target, delta), in update mode: per batch each edge that is new, gone or changed.

    The state of an edge is its weight, so a restart goes on where the last batch ended. An edge of less than ``least`` links isn't shown; its weight is null once it is gone.
    Links whose neurons or delta are null don't count.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = state.get[0] if state.exists else 0
        new = old + sum(int(b["delta"].sum()) for b in batches)
        state.update((new,))
        before, after = old >= least, new >= least
        change = "new" if after and not before else "gone" if before and not after else "changed" if after and new != old else None
        if change:
            yield pd.DataFrame({"source": [key[0]], "target": [key[1]], "change": [change], "weight": pd.array([new if after else None], "Int64")})

    known = events.where("source IS NOT NULL AND target IS NOT NULL AND delta IS NOT NULL").select("source", "target", F.col("delta").cast("long").alias("delta"))
    kinds = dict(known.dtypes)
    return known.groupBy("source", "target").applyInPandasWithState(step, f"source {kinds['source']}, target {kinds['target']}, change string, weight long", "weight long", "update", GroupStateTimeout.NoTimeout)
