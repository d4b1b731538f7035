"""Connectivity queries over the star-schema views, with their SQL."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import connectivity as c
from ..operators.quantiles import value_at
from ..operators.trees import cut
from ..sources import lake

CTE = "connectors AS (SELECT o_orderkey AS connector_id, o_custkey AS pre FROM orders), links AS (SELECT l_orderkey AS connector_id, l_suppkey AS post, (l_linenumber - 1) % 5 + 1 AS confidence FROM lineitem), edges AS (SELECT pre AS source, post AS target, count(*) AS weight FROM connectors JOIN links USING (connector_id) GROUP BY 1, 2)"


def _tables(spark, d):
    return lake.connectors(spark, d), lake.links(spark, d)


def _places(spark, d):
    return c.places(spark, lake.table(spark, d, "lineitem").count())


def _edges(spark, d, **how):
    return c.edges(*_tables(spark, d), parts=_places(spark, d), **how)


def _ids(df, column, where):
    return df.where(where).select(F.col(column).alias("id"))


def _customers(spark, d, where):
    return _ids(lake.table(spark, d, "customer"), "c_custkey", where)


def _suppliers(spark, d, where="true"):
    return _ids(lake.table(spark, d, "supplier"), "s_suppkey", where)


def edge_table(spark, d):
    return _edges(spark, d)


def edges_confident(spark, d):
    return _edges(spark, d, min_confidence=4)


def adjacency_matrix(spark, d):
    out = c.adjacency(_edges(spark, d), _customers(spark, d, "c_mktsegment = 'BUILDING'"), _suppliers(spark, d, "s_acctbal > 0"), syn_threshold=2, syn_cutoff=3)
    return out


def adjacency_fractions(spark, d):
    out = c.adjacency(_edges(spark, d), _customers(spark, d, "c_nationkey = 3"), _suppliers(spark, d), fractions=True)
    return out.withColumn("weight", F.round("weight", 9))


def _grouped(method):
    def run(spark, d):
        nation = lake.table(spark, d, "nation")
        rows = lake.table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("id"), F.col("n_name").alias("grp"))
        cols = lake.table(spark, d, "supplier").where("s_nationkey % 2 = 0").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("id"), F.col("n_name").alias("grp"))
        out = c.group_matrix(_edges(spark, d), rows, cols, method)
        return out.withColumn("weight", F.round(F.col("weight").cast("double"), 6))

    return run


def _grouped_sql(fn):
    return f"""WITH {CTE}, r AS (SELECT n_name AS source, target, {fn}(weight) AS weight FROM edges JOIN customer ON source = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
SELECT source, coalesce(n_name, CAST(target AS VARCHAR)) AS target, round(CAST({fn}(weight) AS DOUBLE), 6) AS weight FROM r
LEFT JOIN (SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_nationkey % 2 = 0) ON target = s_suppkey GROUP BY 1, 2"""


def _sizes(spark, d):
    connectors, links = _tables(spark, d)
    counts = c.connectivity_counts(connectors, links, parts=_places(spark, d))
    return counts.where("relation = 'postsynaptic_to'").select("id", F.col("count").alias("num_nodes"))


def get_partners(spark, d):
    query = _customers(spark, d, "c_custkey < 40")
    return c.partners(_edges(spark, d), query, _sizes(spark, d), threshold=2, min_size=5).where("relation = 'downstream'").drop("relation")


def partners_all(spark, d):
    """get_partners from all neurons."""
    return c.partners(_edges(spark, d), _customers(spark, d, "true"), _sizes(spark, d), threshold=2, min_size=5).where("relation = 'downstream'").drop("relation")


def partners_wide(spark, d):
    query = _customers(spark, d, "c_custkey < 4")
    long = c.partners(_edges(spark, d), query, _sizes(spark, d)).where("relation = 'downstream'")
    return c.wide(long, ["partner", "num_nodes", "total"], "query", [0, 1, 2, 3]).toDF("partner", "num_nodes", "total", "q0", "q1", "q2", "q3")


def shared_partners(spark, d):
    return c.shared_partners(_edges(spark, d), _customers(spark, d, "c_nationkey = 1"), _customers(spark, d, "c_nationkey = 2"), 3).where("relation = 'downstream'").select("partner", "weight_a", "weight_b")


def connector_details(spark, d):
    out = c.connector_details(*_tables(spark, d))
    return out.select("connector_id", "presynaptic_to", F.array_join("postsynaptic_to", ",").alias("postsynaptic_to"), "n_links")


def connectors_between(spark, d):
    return c.connectors_between(*_tables(spark, d), _customers(spark, d, "c_nationkey = 5"), _suppliers(spark, d, "s_nationkey = 5"))


def _counts(links):
    return lambda spark, d: c.connectivity_counts(*_tables(spark, d), count_links=links, parts=_places(spark, d))


def sparseness_lts(spark, d):
    out = c.sparseness_with_zeros(_edges(spark, d), lake.table(spark, d, "customer").count(), _suppliers(spark, d).withColumnRenamed("id", "target"))
    return out.withColumn("sparseness", F.round("sparseness", 8))


def sparseness_ltk(spark, d):
    return c.sparseness(_edges(spark, d), which="LTK").withColumn("sparseness", F.round("sparseness", 6))


def _people(spark, d):
    """Edges among nations, so that steps may follow one another."""
    cust, supp = lake.table(spark, d, "customer"), lake.table(spark, d, "supplier")
    e = _edges(spark, d).join(cust, F.col("source") == F.col("c_custkey")).join(supp, F.col("target") == F.col("s_suppkey"))
    return e.groupBy(F.col("c_nationkey").alias("source"), F.col("s_nationkey").alias("target")).agg(F.sum("weight").alias("weight"))


NATIONS = "nations AS (SELECT c_nationkey AS source, s_nationkey AS target, sum(weight) AS weight FROM edges JOIN customer ON source = c_custkey JOIN supplier ON target = s_suppkey GROUP BY 1, 2), strong AS (SELECT source, target FROM nations WHERE weight >= (SELECT quantile_disc(weight, 0.9) FROM nations))"


def _strong(spark, d):
    e = cut(_people(spark, d))  # for the level and for the edges
    level = value_at(e, "weight", max(0, math.ceil(0.9 * e.count()) - 1))
    return e.where(F.col("weight") >= level).select("source", "target", "weight")


def nth_partners(spark, d):
    start = spark.range(1).select(F.lit(3).cast("int").alias("id"))
    return c.nth_partners(_strong(spark, d), start, hops=2, min_pre=-1, min_post=1)


def get_paths(spark, d):
    one = lambda i: spark.range(1).select(F.lit(i).cast("int").alias("id"))
    out = c.paths(_strong(spark, d), one(3), lake.table(spark, d, "nation").select(F.col("n_nationkey").alias("id")), [1, 2, 3])
    return out.select(F.array_join("path", ">").alias("path"), "hops")


def _every_hundredth(spark, d):
    return lake.table(spark, d, "customer").where("c_custkey % 100 = 0").select(F.col("c_custkey").alias("id"))


def similarity_queries(spark, d):
    """Neurons whose id is divisible by 100 against all neurons."""
    out = c.similarity_to(_edges(spark, d), _every_hundredth(spark, d))
    return out.withColumns({x: F.round(x, 9) for x in ("matching_index", "matching_index_synapses")})


def _both_ways(spark, d):
    """Customers and suppliers as neurons of one network; suppliers' ids are negative."""
    return _edges(spark, d).select("source", (-F.col("target") - 1).alias("target"), "weight")


def nth_partners_neurons(spark, d):
    return c.nth_partners(_both_ways(spark, d), _every_hundredth(spark, d), hops=2, min_pre=4, min_post=3)


def paths_neurons(spark, d):
    e = _both_ways(spark, d).where("weight >= 3")
    both = e.unionByName(e.select(F.col("target").alias("source"), F.col("source").alias("target"), "weight"))
    out = c.paths(both, _every_hundredth(spark, d), lake.table(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("id")), [2], 3)
    return out.select(F.array_join("path", ">").alias("path"), "hops")


def shared_partners_both(spark, d):
    return c.shared_partners(_both_ways(spark, d), _customers(spark, d, "c_nationkey = 1").unionByName(_suppliers(spark, d, "s_nationkey = 1").select((-F.col("id") - 1).alias("id"))), _customers(spark, d, "c_nationkey = 2").unionByName(_suppliers(spark, d, "s_nationkey = 2").select((-F.col("id") - 1).alias("id"))), 3)


def grouped_only(spark, d):
    cols = lake.table(spark, d, "supplier").where("s_nationkey % 2 = 0").select(F.col("s_suppkey").alias("id"), F.concat(F.lit("n"), "s_nationkey").alias("grp"))
    return c.group_matrix(_edges(spark, d), None, cols, "MAX", drop_ungrouped=True).select(F.col("source").cast("string").alias("source"), "target", "weight")


def connectivity_similarity(spark, d):
    out = c.similarity(_people(spark, d), lake.table(spark, d, "nation").select(F.col("n_nationkey").alias("id")))
    return out.select("a", "b", *[F.round(x, 6).alias(x) for x in out.columns[2:]])


def filter_connectivity(spark, d):
    connectors, links = _tables(spark, d)
    inside = lake.table(spark, d, "orders").where("o_totalprice BETWEEN 50000 AND 150000").select(F.col("o_orderkey").alias("connector_id"))
    return c.edges(c.filter_connectors(connectors, inside), links)


QUERIES = {
    "edges": edge_table, "edges_min_confidence": edges_confident, "adjacency_matrix": adjacency_matrix, "adjacency_fractions": adjacency_fractions,
    "group_matrix_sum": _grouped("SUM"), "group_matrix_average": _grouped("AVERAGE"), "group_matrix_min": _grouped("MIN"), "group_matrix_max": _grouped("MAX"),
    "get_partners": get_partners, "get_partners_all": partners_all, "get_partners_wide": partners_wide, "shared_partners": shared_partners, "connector_details": connector_details,
    "connectors_between": connectors_between, "connectivity_counts_links": _counts(True), "connectivity_counts_connectors": _counts(False),
    "sparseness_lts": sparseness_lts, "sparseness_ltk": sparseness_ltk, "nth_partners": nth_partners, "get_paths": get_paths,
    "connectivity_similarity": connectivity_similarity, "filter_connectivity": filter_connectivity, "similarity_queries": similarity_queries, "nth_partners_neurons": nth_partners_neurons, "get_paths_neurons": paths_neurons,
    "shared_partners_both": shared_partners_both, "group_matrix_grouped_only": grouped_only,
}

SQL = {
    "edges": f"WITH {CTE} SELECT * FROM edges",
    "edges_min_confidence": f"WITH {CTE} SELECT pre AS source, post AS target, count(*) AS weight FROM connectors JOIN links USING (connector_id) WHERE confidence >= 4 GROUP BY 1, 2",
    "adjacency_matrix": f"WITH {CTE} SELECT c_custkey AS source, s_suppkey AS target, CASE WHEN least(coalesce(weight, 0), 3) < 2 THEN 0.0 ELSE CAST(least(weight, 3) AS DOUBLE) END AS weight FROM customer CROSS JOIN supplier LEFT JOIN edges ON source = c_custkey AND target = s_suppkey WHERE c_mktsegment = 'BUILDING' AND s_acctbal > 0",
    "adjacency_fractions": f"WITH {CTE} SELECT c_custkey AS source, s_suppkey AS target, round(coalesce(e.weight, 0) / t.total, 9) AS weight FROM customer CROSS JOIN supplier LEFT JOIN edges e ON source = c_custkey AND target = s_suppkey LEFT JOIN (SELECT target, CAST(sum(weight) AS DOUBLE) AS total FROM edges GROUP BY 1) t ON t.target = s_suppkey WHERE c_nationkey = 3",
    "group_matrix_sum": _grouped_sql("sum"), "group_matrix_average": _grouped_sql("avg"), "group_matrix_min": _grouped_sql("min"), "group_matrix_max": _grouped_sql("max"),
    "get_partners": f"WITH {CTE}, t AS (SELECT target AS partner, CAST(sum(weight) AS BIGINT) AS total FROM edges WHERE source < 40 GROUP BY 1 HAVING sum(weight) >= 2), s AS (SELECT post AS partner, count(*) AS num_nodes FROM links JOIN connectors USING (connector_id) GROUP BY 1 HAVING count(*) >= 5) SELECT partner, num_nodes, source AS query, weight, total FROM edges JOIN t ON target = t.partner JOIN s USING (partner) WHERE source < 40",
    "get_partners_wide": f"WITH {CTE}, s AS (SELECT post AS partner, count(*) AS num_nodes FROM links JOIN connectors USING (connector_id) GROUP BY 1 HAVING count(*) >= 2) SELECT target AS partner, num_nodes, CAST(sum(weight) AS BIGINT) AS total, CAST(coalesce(sum(weight) FILTER (source = 0), 0) AS BIGINT) AS q0, CAST(coalesce(sum(weight) FILTER (source = 1), 0) AS BIGINT) AS q1, CAST(coalesce(sum(weight) FILTER (source = 2), 0) AS BIGINT) AS q2, CAST(coalesce(sum(weight) FILTER (source = 3), 0) AS BIGINT) AS q3 FROM edges JOIN s ON partner = target WHERE source < 4 GROUP BY 1, 2",
    "shared_partners": f"WITH {CTE} SELECT target AS partner, CAST(sum(CASE WHEN c_nationkey = 1 THEN weight ELSE 0 END) AS BIGINT) AS weight_a, CAST(sum(CASE WHEN c_nationkey = 2 THEN weight ELSE 0 END) AS BIGINT) AS weight_b FROM edges JOIN customer ON source = c_custkey GROUP BY 1 HAVING weight_a >= 3 AND weight_b >= 3",
    "connector_details": f"WITH {CTE} SELECT c.connector_id, c.pre AS presynaptic_to, coalesce(string_agg(DISTINCT CAST(post AS VARCHAR), ',' ORDER BY post), '') AS postsynaptic_to, count(post) AS n_links FROM connectors c LEFT JOIN links USING (connector_id) GROUP BY 1, 2".replace("string_agg(DISTINCT CAST(post AS VARCHAR), ',' ORDER BY post)", "array_to_string(list_sort(list_distinct(list(post) FILTER (post IS NOT NULL))), ',')"),
    "connectors_between": f"WITH {CTE} SELECT connector_id, pre AS source, post AS target, confidence FROM connectors JOIN links USING (connector_id) JOIN customer ON pre = c_custkey JOIN supplier ON post = s_suppkey WHERE c_nationkey = 5 AND s_nationkey = 5",
    "connectivity_counts_links": f"WITH {CTE}, f AS (SELECT * FROM connectors JOIN links USING (connector_id)) SELECT pre AS id, 'presynaptic_to' AS relation, count(*) AS count FROM f GROUP BY 1 UNION ALL SELECT post, 'postsynaptic_to', count(*) FROM f GROUP BY 1",
    "connectivity_counts_connectors": f"WITH {CTE}, f AS (SELECT * FROM connectors JOIN links USING (connector_id)) SELECT pre AS id, 'presynaptic_to' AS relation, count(DISTINCT connector_id) AS count FROM f GROUP BY 1 UNION ALL SELECT post, 'postsynaptic_to', count(DISTINCT connector_id) FROM f GROUP BY 1",
    "sparseness_lts": f"WITH {CTE}, g AS (SELECT s_suppkey AS target, CAST(coalesce(weight, 0) AS DOUBLE) AS w FROM customer CROSS JOIN supplier LEFT JOIN edges ON source = c_custkey AND target = s_suppkey) SELECT target, round((1 - power(sum(w) / count(w), 2) / nullif(sum(w * w) / count(w), 0)) / (1 - 1.0 / count(w)), 8) AS sparseness FROM g GROUP BY 1",
    "sparseness_ltk": f"WITH {CTE} SELECT target, round(kurtosis_pop(CAST(weight AS DOUBLE)), 6) AS sparseness FROM edges GROUP BY 1",
    "nth_partners": f"WITH {CTE}, {NATIONS}, one AS (SELECT DISTINCT target AS id FROM strong WHERE source = 3 AND target <> 3), two AS (SELECT DISTINCT target AS id FROM strong JOIN one ON source = id WHERE target <> 3 AND target NOT IN (SELECT id FROM one)) SELECT 3 AS id, 0 AS hop UNION ALL SELECT id, 1 FROM one UNION ALL SELECT id, 2 FROM two",
    "get_paths": f"WITH RECURSIVE {CTE}, {NATIONS}, p AS (SELECT [3] AS path, 3 AS last, 0 AS hops UNION ALL SELECT list_append(path, target), target, hops + 1 FROM p JOIN strong ON source = last WHERE hops < 3 AND NOT list_contains(path, target)) SELECT array_to_string(path, '>') AS path, hops FROM p WHERE hops > 0",
    "connectivity_similarity": f"""WITH {CTE}, {NATIONS}, g AS (SELECT a.n_nationkey AS a, b.n_nationkey AS b, t.target, coalesce(x.weight, 0)::DOUBLE AS wa, coalesce(y.weight, 0)::DOUBLE AS wb FROM nation a CROSS JOIN nation b CROSS JOIN (SELECT DISTINCT target FROM nations) t LEFT JOIN nations x ON x.source = a.n_nationkey AND x.target = t.target LEFT JOIN nations y ON y.source = b.n_nationkey AND y.target = t.target),
s AS (SELECT a, b, sum((wa > 0 AND wb > 0)::INT) AS n, sum((wa > 0 OR wb > 0)::INT) AS m, sum(CASE WHEN wa > 0 AND wb > 0 THEN wa ELSE 0 END) AS sa, sum(CASE WHEN wa > 0 AND wb > 0 THEN wb ELSE 0 END) AS sb, sum(wa) AS ta, sum(wb) AS tb, sum(least(wa, wb) - 0.5 * greatest(wa, wb) * exp(-least(wa, wb))) AS v, sum(greatest(wa, wb) - 0.5 * greatest(wa, wb) * exp(-greatest(wa, wb))) AS hi, sum(-0.5 * greatest(wa, wb)) AS lo FROM g GROUP BY 1, 2)
SELECT a, b, round(n / nullif(m, 0), 6) AS matching_index, round((sa + sb) / nullif(ta + tb, 0), 6) AS matching_index_synapses, round(coalesce(sa / nullif(ta, 0), 0) * coalesce(sb / nullif(tb, 0), 0), 6) AS matching_index_weighted_synapses, round(v, 6) AS vertex, round((v - lo) / nullif(hi - lo, 0), 6) AS vertex_normalized FROM s""",
    "get_partners_all": f"WITH {CTE}, s AS (SELECT post AS partner, count(*) AS num_nodes FROM links JOIN connectors USING (connector_id) GROUP BY 1 HAVING count(*) >= 5) SELECT partner, num_nodes, source AS query, weight, total FROM (SELECT target AS partner, source, weight, CAST(sum(weight) OVER (PARTITION BY target) AS BIGINT) AS total FROM edges) JOIN s USING (partner) WHERE total >= 2",
    "similarity_queries": f"WITH {CTE}, t AS (SELECT source, count(*) AS n, sum(weight) AS s FROM edges GROUP BY 1), p AS (SELECT x.source AS a, y.source AS b, count(*) AS k, sum(x.weight + y.weight) AS s FROM edges x JOIN edges y USING (target) WHERE x.source % 100 = 0 GROUP BY 1, 2) SELECT a, b, k AS both, round(k / (u.n + v.n - k), 9) AS matching_index, round(p.s / (u.s + v.s), 9) AS matching_index_synapses FROM p JOIN t u ON u.source = a JOIN t v ON v.source = b",
    "nth_partners_neurons": f"WITH {CTE}, step AS (SELECT source AS id, -target - 1 AS nxt FROM edges WHERE weight >= 3 UNION SELECT -target - 1, source FROM edges WHERE weight >= 4), zero AS (SELECT c_custkey AS id FROM customer WHERE c_custkey % 100 = 0), one AS (SELECT DISTINCT nxt AS id FROM step JOIN zero USING (id) WHERE nxt NOT IN (SELECT id FROM zero)), two AS (SELECT DISTINCT nxt AS id FROM step JOIN one USING (id) WHERE nxt NOT IN (SELECT id FROM zero UNION SELECT id FROM one)) SELECT id, 0 AS hop FROM zero UNION ALL SELECT id, 1 FROM one UNION ALL SELECT id, 2 FROM two",
    "get_paths_neurons": f"WITH {CTE}, e AS (SELECT * FROM edges WHERE weight >= 3) SELECT concat_ws('>', x.source, -x.target - 1, y.source) AS path, 2 AS hops FROM e x JOIN e y ON x.target = y.target AND x.source <> y.source JOIN customer ON c_custkey = y.source WHERE x.source % 100 = 0 AND c_acctbal > 5000",
    "shared_partners_both": f"WITH {CTE}, c AS (SELECT c_custkey AS id, c_nationkey AS n FROM customer), s AS (SELECT s_suppkey AS id, s_nationkey AS n FROM supplier), r AS (SELECT 'downstream' AS relation, -target - 1 AS partner, n, weight FROM edges JOIN c ON id = source UNION ALL SELECT 'upstream', source, n, weight FROM edges JOIN s ON id = target) SELECT relation, partner, CAST(sum(CASE WHEN n = 1 THEN weight ELSE 0 END) AS BIGINT) AS weight_a, CAST(sum(CASE WHEN n = 2 THEN weight ELSE 0 END) AS BIGINT) AS weight_b FROM r GROUP BY 1, 2 HAVING weight_a >= 3 AND weight_b >= 3",
    "group_matrix_grouped_only": f"WITH {CTE} SELECT CAST(source AS VARCHAR) AS source, 'n' || CAST(s_nationkey AS VARCHAR) AS target, max(weight) AS weight FROM edges JOIN supplier ON s_suppkey = target WHERE s_nationkey % 2 = 0 GROUP BY 1, 2",
    "filter_connectivity": f"WITH {CTE} SELECT pre AS source, post AS target, count(*) AS weight FROM connectors JOIN links USING (connector_id) JOIN orders ON o_orderkey = connector_id WHERE o_totalprice BETWEEN 50000 AND 150000 GROUP BY 1, 2",
}
