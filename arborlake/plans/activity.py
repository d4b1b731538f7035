"""Queries of user statistics, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import activity as a
from ..sources import lake

ACT = "act AS (SELECT user_id, ts, event_type AS action FROM events)"
FLOOR = "CAST(floor(date_diff('second', {o}, ts) / {w}) AS BIGINT)"


def time_sum(spark, d):
    return a.time_invested(lake.actions(spark, d), 420, 2 / 420)


def time_kind(spark, d):
    return a.time_invested_by_kind(lake.actions(spark, d), 420, 2 / 420)


def actions_per_day(spark, d):
    return a.actions_per_day(lake.actions(spark, d)).withColumn("day", F.col("day").cast("string"))


def over_time(spark, d):
    return a.bins_over_time(lake.actions(spark, d), 420, 2 / 420).withColumn("day", F.col("day").cast("string"))


def user_stats(spark, d):
    return a.user_stats(lake.actions(spark, d), ["click", "purchase"], "2024-01-05", "2024-01-20")


def history(spark, d):
    return a.history(lake.actions(spark, d)).withColumn("day", F.col("day").cast("string"))


def teams(spark, d):
    team = lake.actions(spark, d).where("user_id % 3 <> 0").select("user_id", F.concat(F.lit("team"), F.col("user_id") % 3).alias("team")).distinct()
    return a.user_contributions(lake.actions(spark, d), team)


def team_dates(spark, d):
    member = lake.actions(spark, d).select("user_id").distinct().select("user_id", F.concat(F.lit("team"), F.col("user_id") % 4).alias("team"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("user_id") % 10).cast("int")).alias("since"), F.date_add(F.lit("2024-01-10").cast("date"), (F.col("user_id") % 15).cast("int")).alias("until"))
    return a.team_contributions(lake.actions(spark, d), member)


def review(spark, d):
    docs, labels = lake.table(spark, d, "documents"), lake.table(spark, d, "labels")
    nodes = docs.join(labels.select("doc_id", F.lit(True).alias("reviewed")), "doc_id", "left").select("source", F.col("doc_id").alias("node_id"), F.coalesce("reviewed", F.lit(False)).alias("reviewed"))
    return a.review_status(nodes, "source")


def logs(spark, d):
    return a.logs(lake.actions(spark, d), ["click"], 50, 10)


def statistics(spark, d):
    out = a.contributor_statistics(lake.actions(spark, d))
    return out.select("action", F.size("users").alias("users"), F.aggregate(F.map_values("users"), F.lit(0).cast("long"), lambda x, y: x + y).alias("n"))


def latest(spark, d):
    return a.latest_action(lake.actions(spark, d))


QUERIES = {"time_invested_sum": time_sum, "time_invested_by_kind": time_kind, "time_invested_actions": actions_per_day, "time_invested_over_time": over_time, "user_stats": user_stats, "user_history": history, "user_contributions_teams": teams, "team_contributions": team_dates, "review_status": review, "get_logs": logs, "contributor_statistics": statistics, "latest_action": latest}

_ORIGIN = "(SELECT CAST(min(ts) AS DATE)::TIMESTAMP FROM act)"
SQL = {
    "time_invested_sum": f"WITH {ACT}, b AS (SELECT user_id, {FLOOR.format(o=_ORIGIN, w=25200)} AS bin, count(*) AS n FROM act GROUP BY 1, 2) SELECT user_id, CAST(sum(CASE WHEN n >= 2 THEN 420 ELSE 0 END) AS BIGINT) AS minutes FROM b GROUP BY 1 HAVING sum(n) >= 2",
    "time_invested_by_kind": f"WITH {ACT}, b AS (SELECT user_id, action, {FLOOR.format(o=_ORIGIN, w=25200)} AS bin, count(*) AS n FROM act GROUP BY 1, 2, 3) SELECT user_id, action, CAST(sum(CASE WHEN n >= 2 THEN 420 ELSE 0 END) AS BIGINT) AS minutes FROM b GROUP BY 1, 2",
    "time_invested_actions": f"WITH {ACT}, p AS (SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM act GROUP BY 1, 2 UNION ALL SELECT 'all_groups', CAST(ts AS DATE), count(*) FROM act GROUP BY 2), days AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM p)::TIMESTAMP, (SELECT max(day) FROM p)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day) SELECT u.user_id, CAST(d.day AS VARCHAR) AS day, CAST(coalesce(n, 0) AS BIGINT) AS actions FROM (SELECT DISTINCT user_id FROM p) u CROSS JOIN days d LEFT JOIN p USING (user_id, day)",
    "time_invested_over_time": f"WITH {ACT}, o AS (SELECT user_id, CAST(min(ts) AS DATE)::TIMESTAMP AS origin FROM act GROUP BY 1), b AS (SELECT user_id, origin, {FLOOR.format(o='origin', w=25200)} AS bin FROM act JOIN o USING (user_id)), q AS (SELECT user_id, origin, bin FROM b GROUP BY 1, 2, 3 HAVING count(*) >= 2) SELECT user_id, CAST(CAST(origin + to_minutes(bin * 420) AS DATE) AS VARCHAR) AS day, count(*) AS bins, count(*) * 420 AS minutes FROM q GROUP BY 1, 2",
    "user_stats": f"WITH {ACT} SELECT user_id, count(*) FILTER (action = 'click') AS click, count(*) FILTER (action = 'purchase') AS purchase FROM act WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1",
    "user_history": f"WITH {ACT} SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, action, count(*) AS n FROM act GROUP BY 1, 2, 3",
    "user_contributions_teams": f"WITH {ACT} SELECT CASE WHEN user_id % 3 = 0 THEN 'others' ELSE 'team' || (user_id % 3) END AS team, action, count(*) AS n FROM act GROUP BY 1, 2",
    "team_contributions": f"WITH {ACT} SELECT 'team' || (user_id % 4) AS team, action, count(*) AS n FROM act WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' + CAST(user_id % 10 AS INT) AND DATE '2024-01-10' + CAST(user_id % 15 AS INT) GROUP BY 1, 2",
    "review_status": "SELECT source, count(DISTINCT d.doc_id) AS total_node_count, count(DISTINCT l.doc_id) AS nodes_reviewed, CAST(count(DISTINCT l.doc_id) * 100 // count(DISTINCT d.doc_id) AS BIGINT) AS percent_reviewed FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1",
    "get_logs": f"WITH {ACT} SELECT * FROM act WHERE action = 'click' ORDER BY ts DESC, user_id, action LIMIT 50 OFFSET 10",
    "contributor_statistics": f"WITH {ACT} SELECT action, CAST(count(DISTINCT user_id) AS INT) AS users, count(*) AS n FROM act GROUP BY 1",
    "latest_action": f"WITH {ACT} SELECT user_id, ts, action FROM act QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, action) = 1",
}
