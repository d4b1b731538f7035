"""User statistics from actions (user_id, ts, action), ts without time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def midnight(ts: Column) -> Column:
    return F.to_date(ts).cast("timestamp_ntz")


def bins(actions: DataFrame, minutes: int, by: list[str] | None = None) -> DataFrame:
    """Actions with ``bin``, numbered from midnight of the first day: of all actions, or of each group of ``by``."""
    first = actions.groupBy(*(by or [])).agg(midnight(F.min("ts")).alias("origin"))
    out = actions.join(first, by) if by else actions.join(F.broadcast(first), F.lit(True))  # one row
    seconds = F.expr("timestampdiff(SECOND, origin, ts)")
    return out.withColumn("bin", F.floor(seconds / F.lit(minutes * 60)))


def time_invested(actions: DataFrame, minutes: int = 3, minimum: int = 10, by: str = "user_id") -> DataFrame:
    """(by, minutes): a bin of ``minutes`` counts whole when it holds ``minimum * minutes`` actions; groups with fewer in total are left out."""
    need = minimum * minutes
    per = bins(actions, minutes).groupBy(by, "bin").agg(F.count("*").alias("n"))
    return per.groupBy(by).agg(F.sum("n").alias("total"), F.sum(F.when(F.col("n") >= need, minutes).otherwise(0)).alias("minutes")).where(F.col("total") >= need).select(by, "minutes")


def time_invested_by_kind(actions: DataFrame, minutes: int = 3, minimum: int = 10, by: str = "user_id") -> DataFrame:
    """Like ``time_invested`` with a row for each kind of action, whose bins are counted apart."""
    need = minimum * minutes
    per = bins(actions, minutes).groupBy(by, "action", "bin").agg(F.count("*").alias("n"))
    return per.groupBy(by, "action").agg(F.sum(F.when(F.col("n") >= need, minutes).otherwise(0)).alias("minutes"))


def _days(actions: DataFrame) -> DataFrame:
    span = actions.agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b"))
    return span.where("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("day"))


def actions_per_day(actions: DataFrame, by: str = "user_id") -> DataFrame:
    """(by, day, actions) for every day between the first and the last, with 0 for none, and the rows of ``all_groups``."""
    per = actions.groupBy(F.col(by).cast("string").alias(by), F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    per = per.unionByName(per.groupBy("day").agg(F.sum("n").alias("n")).withColumn(by, F.lit("all_groups")))
    grid = per.select(by).distinct().join(F.broadcast(_days(actions)), F.lit(True))  # a calendar of days
    return grid.join(per, [by, "day"], "left").select(by, "day", F.coalesce("n", F.lit(0)).cast("long").alias("actions"))


def bins_over_time(actions: DataFrame, minutes: int = 3, minimum: int = 10, by: str = "user_id") -> DataFrame:
    """(by, day, bins, minutes): qualifying bins of each day, bins counted from each group's first midnight."""
    per = bins(actions, minutes, [by]).groupBy(by, "origin", "bin").agg(F.count("*").alias("n")).where(F.col("n") >= minimum * minutes)
    day = F.to_date(F.expr(f"timestampadd(MINUTE, CAST(bin * {minutes} AS INT), origin)"))
    return per.groupBy(by, day.alias("day")).agg(F.count("*").alias("bins"), (F.count("*") * minutes).alias("minutes"))


def user_stats(actions: DataFrame, kinds: list[str], start: str | None = None, end: str | None = None) -> DataFrame:
    """Per user the number of actions of each kind in a period (the end day is excluded)."""
    if start:
        actions = actions.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        actions = actions.where(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    return actions.groupBy("user_id").agg(*[F.count_if(F.col("action") == k).alias(k) for k in kinds])


def history(actions: DataFrame) -> DataFrame:
    """(user_id, day, action, n)."""
    return actions.groupBy("user_id", F.to_date("ts").alias("day"), "action").agg(F.count("*").alias("n"))


def user_contributions(actions: DataFrame, teams: DataFrame | None = None) -> DataFrame:
    """(user or team, action, n). teams: (user_id, team); users of none are ``others``."""
    if teams is None:
        return actions.groupBy("user_id", "action").agg(F.count("*").alias("n"))
    return actions.join(teams, "user_id", "left").groupBy(F.coalesce("team", F.lit("others")).alias("team"), "action").agg(F.count("*").alias("n"))


def team_contributions(actions: DataFrame, membership: DataFrame) -> DataFrame:
    """(team, action, n) of actions on days within the user's membership (user_id, team, since, until)."""
    own = actions.join(membership, "user_id").where(F.to_date("ts").between(F.col("since"), F.col("until")))
    return own.groupBy("team", "action").agg(F.count("*").alias("n"))


def team_contributions_by_neuron(actions: DataFrame, membership: DataFrame, minutes: int = 3, minimum: float = 10.0) -> DataFrame:
    """(neuron, team, action, n, minutes) as ``team_contributions``, for actions with a neuron; minutes are the time that the team invested in the neuron, over all kinds of actions (see ``time_invested``)."""
    own = actions.join(membership, "user_id").where(F.to_date("ts").between(F.col("since"), F.col("until")))
    counts = own.groupBy("neuron", "team", "action").agg(F.count("*").alias("n"))
    pair = F.struct("neuron", "team")
    time = time_invested(own.withColumn("__pair", pair), minutes, minimum, by="__pair").select("__pair.neuron", "__pair.team", "minutes")
    return counts.join(time, ["neuron", "team"], "left").na.fill(0, ["minutes"])


def contributions_by_neuron(actions: DataFrame) -> DataFrame:
    """(neuron, action, user_id, n): who did how much on each neuron by itself, as rows; ``contributor_statistics`` has all neurons in one."""
    return actions.groupBy("neuron", "action", "user_id").agg(F.count("*").alias("n"))


def review_status(nodes: DataFrame, by: str) -> DataFrame:
    """(by, total_node_count, nodes_reviewed, percent_reviewed): the percentage is truncated. nodes: by, node_id, reviewed."""
    total = F.count_distinct("node_id")
    done = F.count_distinct(F.when(F.col("reviewed"), F.col("node_id")))
    return nodes.groupBy(by).agg(total.alias("total_node_count"), done.alias("nodes_reviewed"), F.floor(F.try_divide(done * 100, total)).alias("percent_reviewed"))


def logs(actions: DataFrame, operations: list[str], entries: int, start: int = 0) -> DataFrame:
    """A page of the log, newest first."""
    out = actions.where(F.col("action").isin(operations)) if operations else actions
    return out.orderBy(F.desc("ts"), "user_id", "action").offset(start).limit(entries)


def contributor_statistics(actions: DataFrame) -> DataFrame:
    """(action, users): per kind a map from user to its number of actions."""
    return actions.groupBy("action", "user_id").agg(F.count("*").alias("n")).groupBy("action").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("user_id", "n")))).alias("users"))


def latest_action(actions: DataFrame) -> DataFrame:
    """The last row of each user; of equal times the one of the largest action."""
    last = actions.groupBy("user_id").agg(F.max_by(F.struct(*actions.columns), F.struct("ts", "action")).alias("__last"))
    return last.select("__last.*")
