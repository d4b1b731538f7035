"""Queries over whole tables where others ask for a part: partners on both sides, facts of neurons, teams by neuron, density of groups, parts of trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import activity, connectivity, search, trees
from ..sources import lake
from . import network
from .shapes import ANCESTORS, SEGMENTS, UP, _round


def partners_both(s, d):
    """Partners on both sides of all customers and suppliers, as one set of neurons."""
    everyone = lake.table(s, d, "customer").select(F.col("c_custkey").alias("id")).unionByName(lake.table(s, d, "supplier").select(F.col("s_suppkey").alias("id"))).distinct()
    return connectivity.partners(network.edge_table(s, d), everyone, network._sizes(s, d), threshold=3, min_size=5)


def neurons_of_facts(s, d):
    """Skeletons with a node named a to c, enough nodes and cable and a thick node tagged as soma."""
    n = lake.treenodes(s, d)
    named = lake.table(s, d, "part").where("p_name < 'd'").select(F.col("p_partkey").alias("node_id"))
    sets = [n.join(named, "node_id", "left_semi").select(F.col("skeleton_id").alias("entity_id")).distinct(), lake.skeletons(s, d).where("name LIKE 'Brand#%'").select(F.col("skeleton_id").alias("entity_id"))]
    soma = lake.tags(s, d).where("tag = 'soma' AND kind = 'node'").select("node_id")
    facts = n.groupBy("skeleton_id").agg(F.count("*").alias("num_nodes")).join(trees.cable(n, "skeleton_id"), "skeleton_id")
    thick = n.where("radius >= 48").join(soma, "node_id", "left_semi").select("skeleton_id").distinct().withColumn("has_soma", F.lit(True))
    facts = facts.join(thick, "skeleton_id", "left").select(F.col("skeleton_id").alias("entity_id"), "num_nodes", F.coalesce("has_soma", F.lit(False)).alias("has_soma"), "cable")
    return search.find_neurons(sets, facts, intersect=True, only_soma=True, min_size=20, min_cable=facts.agg(F.avg("cable")).first()[0] or 0.0)


def _members(s, d):
    acts = lake.table(s, d, "events").select("user_id", (F.col("event_id") % 40).alias("neuron"), "ts", F.col("event_type").alias("action"))
    day = lambda start, n: F.date_add(F.lit(start).cast("date"), n.cast("int"))
    member = acts.select("user_id").distinct().select("user_id", F.concat(F.lit("team"), F.col("user_id") % 4).alias("team"), day("2024-01-01", F.col("user_id") % 10).alias("since"), day("2024-01-10", F.col("user_id") % 15).alias("until"))
    return acts, member


def teams_by_neuron(s, d):
    return activity.team_contributions_by_neuron(*_members(s, d), 420, 1 / 140)


def by_neuron(s, d):
    return activity.contributions_by_neuron(_members(s, d)[0])


def _density(method):
    def run(s, d):
        contacts = lake.table(s, d, "lineitem").select(F.col("l_suppkey").alias("grp"), F.col("l_partkey").alias("node_id"))
        return _round(trees.connection_density(lake.nodes(s, d), contacts, method, 1e6), "density", digits=9)

    return run


QUERIES = {
    "get_partners_both": partners_both, "find_neurons_facts": neurons_of_facts, "team_contributions_by_neuron": teams_by_neuron, "contributions_by_neuron": by_neuron,
    "connection_density_sum": _density("SUM"), "connection_density_average": _density("AVERAGE"),
    "prune_by_strahler": lambda s, d: trees.prune_by_strahler(lake.nodes(s, d), [1, -1]).select("node_id", "parent_id"), "longest_parts": lambda s, d: trees.longest_parts(lake.nodes(s, d), 20),
}

_ACT = "a AS (SELECT user_id, event_id % 40 AS neuron, ts, event_type AS action FROM events)"
_OWN = "o AS (SELECT *, 'team' || (user_id % 4) AS team FROM a WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' + CAST(user_id % 10 AS INT) AND DATE '2024-01-10' + CAST(user_id % 15 AS INT))"
_STRAHLER = "st AS (SELECT hops, node_id, parent_id, 1 AS s FROM r WHERE hops = (SELECT max(hops) FROM r) UNION ALL SELECT r.hops, r.node_id, r.parent_id, coalesce(t, 1) FROM r LEFT JOIN (SELECT p, l[1] + CASE WHEN len(l) > 1 AND l[1] = l[2] THEN 1 ELSE 0 END AS t FROM (SELECT parent_id AS p, list_reverse_sort(list(s)) AS l FROM st GROUP BY 1)) ON p = r.node_id WHERE r.hops = (SELECT max(hops) - 1 FROM st))"


def _density_sql(value: str) -> str:
    return f"WITH RECURSIVE {UP}, {ANCESTORS}, c AS (SELECT l_suppkey AS grp, l_partkey AS node_id FROM lineitem), k AS (SELECT grp, a AS node_id, count(*) AS k FROM c JOIN an USING (node_id) GROUP BY 1, 2), t AS (SELECT grp, count(*) AS n FROM c GROUP BY 1), s AS (SELECT grp, n, sum(length * k * (n - k)) AS s FROM k JOIN t USING (grp) JOIN e USING (node_id) GROUP BY 1, 2) SELECT grp, round(1e6 / nullif({value}, 0), 9) AS density FROM s"


SQL = {
    "get_partners_both": f"WITH {network.CTE}, i AS (SELECT c_custkey AS id FROM customer UNION SELECT s_suppkey FROM supplier), w AS (SELECT 'downstream' AS relation, target AS partner, source AS query, weight FROM edges WHERE source IN (SELECT id FROM i) UNION ALL SELECT 'upstream', source, target, weight FROM edges WHERE target IN (SELECT id FROM i)), z AS (SELECT post AS partner, count(*) AS num_nodes FROM links JOIN connectors USING (connector_id) GROUP BY 1 HAVING count(*) >= 5) SELECT relation, partner, num_nodes, query, weight, total FROM (SELECT *, CAST(sum(weight) OVER (PARTITION BY relation, partner) AS BIGINT) AS total FROM w) JOIN z USING (partner) WHERE total >= 3",
    "find_neurons_facts": f"WITH RECURSIVE {UP}, m AS (SELECT node_id, CAST(substr(p_brand, 7) AS BIGINT) AS s, p_name, p_size, length FROM e JOIN part ON p_partkey = node_id), f AS (SELECT s, count(*) AS k, sum(length) AS cable, count(*) FILTER (p_size >= 48 AND node_id % 5 = 0) > 0 AS soma, count(*) FILTER (p_name < 'd') > 0 AS named FROM m GROUP BY 1) SELECT s AS entity_id FROM f WHERE named AND soma AND k >= 20 AND cable >= (SELECT avg(cable) FROM f)",
    "team_contributions_by_neuron": f"WITH {_ACT}, {_OWN}, b AS (SELECT neuron, team, floor(epoch(ts - (SELECT date_trunc('day', min(ts)) FROM o)) / 25200) AS bin, count(*) AS n FROM o GROUP BY ALL), m AS (SELECT neuron, team, CAST(sum(CASE WHEN n >= 3 THEN 420 ELSE 0 END) AS BIGINT) AS minutes FROM b GROUP BY 1, 2 HAVING sum(n) >= 3) SELECT neuron, team, action, count(*) AS n, coalesce(any_value(minutes), 0) AS minutes FROM o LEFT JOIN m USING (neuron, team) GROUP BY 1, 2, 3",
    "contributions_by_neuron": f"WITH {_ACT} SELECT neuron, action, user_id, count(*) AS n FROM a GROUP BY 1, 2, 3",
    "connection_density_sum": _density_sql("s"), "connection_density_average": _density_sql("s / (n * (n - 1) / 2)"),
    "prune_by_strahler": f"WITH RECURSIVE {UP}, {_STRAHLER}, k AS (SELECT node_id, parent_id FROM st WHERE s <> 1 AND s <> (SELECT max(s) FROM st)) SELECT node_id, CASE WHEN parent_id IN (SELECT node_id FROM k) THEN parent_id END AS parent_id FROM k",
    "longest_parts": f"WITH RECURSIVE {UP}, {SEGMENTS}, top AS (SELECT segment FROM seg JOIN e USING (node_id) GROUP BY 1 ORDER BY sum(length) DESC, segment LIMIT 20) SELECT an.node_id, arg_max(segment, r.hops) AS part FROM an JOIN seg ON seg.node_id = an.a JOIN r ON r.node_id = an.a WHERE segment IN (SELECT segment FROM top) GROUP BY 1",
}
