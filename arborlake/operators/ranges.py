"""How far a value of a sequence is not exceeded: what sums of extremes over all stretches of a sequence need, without the stretches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .trees import cut, spread

#: Rows of a sequence that one task looks at at once.
BLOCK = 1 << 16


def _inside(keys: list[str]):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([*keys, "at"], ignore_index=True)
        own, value = rows.groupby(keys, sort=False).ngroup().tolist(), rows["value"].tolist()
        low, high, open_, before = [-1] * len(own), [-1] * len(own), [], None
        for i, v in enumerate(value):
            if own[i] != before:
                open_, before = [], own[i]
            while open_ and value[open_[-1]] < v:
                high[open_.pop()] = i
            if open_:
                low[i] = open_[-1]
            open_.append(i)
        for name, to in (("low", low), ("high", high)):
            to = pd.Series(to)
            for c, source in ((name, "at"), (f"{name}_upto", "upto")):
                rows[c] = rows[source].take(to.clip(lower=0)).set_axis(rows.index).where(to >= 0)
        return rows

    return run


def spans(rows: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """``rows`` (keys, at, value, upto) with ``low``, the last place before a row's whose value is at least its own, and ``high``, the first place after it whose
    value is larger, both with the ``upto`` there; null where there is none. Of the rows of a stretch exactly one has the whole stretch between its two places.

    ``at`` counts the rows of the same keys from about 0. Blocks of a sequence are looked at by themselves, short sequences several at once; what reaches beyond a block then
    looks for the block by the blocks' largest values, and for the row in it among those that no other of the block hides.
    """
    rows = cut(rows.select(*keys, F.col("at").cast("long").alias("at"), F.col("value").cast("double").alias("value"), F.col("upto").cast("double").alias("upto")))
    n, last = rows.agg(F.count("*"), F.max("at")).first()
    rows = rows.withColumn("block", F.expr(f"at div {block}")).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(n // block + 1)))
    kinds = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    done = rows.groupBy("bucket", "block").applyInPandas(_inside(keys), f"{kinds}, low long, low_upto double, high long, high_upto double").drop("bucket")
    if (last or 0) < block:
        return done.drop("block")
    done = out = cut(done)
    long_ = Window.partitionBy(*keys)
    tops = done.groupBy(*keys, "block").agg(F.max("value").alias("top")).withColumn("n", F.max("block").over(long_)).where("n > 0").select(*keys, F.col("block").alias("to"), "top")
    for side, hidden, meets, pick in (("low", "high", "to < block AND top >= value", F.max), ("high", "low", "to > block AND top > value", F.min)):
        # of the sequences longer than a block, a row a block
        ask = done.where(f"{side} IS NULL").select(*keys, "block", "at", "value").join(F.broadcast(tops), keys).where(meets).groupBy(*keys, "at", "value").agg(pick("to").alias("block"))
        ask = ask.select(*keys, "block", "value", F.lit(None).cast("long").alias("place"), F.lit(None).cast("double").alias("upto"), F.col("at").alias("asks"))
        seen = done.where(f"{hidden} IS NULL").select(*keys, "block", "value", F.col("at").alias("place"), "upto", F.lit(None).cast("long").alias("asks"))
        # an equal value ends a way down, not one up
        equal = F.col("asks").isNotNull() if side == "low" else F.col("asks").isNull()
        order = Window.partitionBy(*keys, "block").orderBy(F.desc("value"), equal, "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        best = pick(F.when(F.col("place").isNotNull(), F.struct("place", "upto"))).over(order)
        far = seen.unionByName(ask).withColumn("best", best).where("asks IS NOT NULL").select(*keys, F.col("asks").alias("at"), F.col("best.place").alias("__at"), F.col("best.upto").alias("__upto"))
        out = out.join(spread(far), [*keys, "at"], "left").withColumns({side: F.coalesce(side, "__at"), f"{side}_upto": F.coalesce(f"{side}_upto", "__upto")}).drop("__at", "__upto")
    return out.drop("block")
