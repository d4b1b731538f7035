"""SQL that gives the rows of the operators' queries on whole tables, written from their contracts.

Each compares everything with everything or sorts whole groups, which is plain but only
fit for small tables; it shares no step with the operator that it checks.
"""

from __future__ import annotations

from .line_dedup import LEAST
from .mixing import WEIGHTS
from .url_filter import DAMPING, LOWER, RULES, TIE, UPPER, steps_of


def _words(column: str, word: str) -> str:
    return f"regexp_extract_all(translate(coalesce({column}, ''), '{UPPER}', '{LOWER}'), '{word}')"


_ALNUM, _NONSPACE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x20\x09-\x0D]+"

#: From links (a, b), both ways: every node's smallest reachable one.
_ROOTS = "reach AS (SELECT DISTINCT a AS node, a AS root FROM links UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node), roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)"

LINES = rf"""
WITH raw AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
each AS (SELECT doc_id, i - 1 AS line, trim(parts[i], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS s FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM raw)),
lines AS (SELECT * FROM each WHERE length(s) >= {LEAST}),
classes AS (SELECT s, min((doc_id, line)) AS first FROM lines GROUP BY s),
short AS (SELECT s, s AS v FROM classes UNION SELECT s, left(s, i - 1) || substr(s, i + 1) FROM (SELECT s, unnest(range(1, length(s) + 1)) AS i FROM classes)),
gone AS (SELECT DISTINCT s FROM (SELECT DISTINCT a.s AS s, b.s AS t FROM short a JOIN short b ON a.v = b.v AND a.s <> b.s) JOIN classes x USING (s) JOIN classes y ON y.s = t WHERE levenshtein(s, t) <= 1 AND y.first < x.first),
judged AS (SELECT doc_id, line, classes.first < (doc_id, line) OR s IN (SELECT s FROM gone) AS drop FROM lines JOIN classes USING (s)),
counts AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (drop) AS n_removed FROM judged GROUP BY doc_id),
pieces AS (SELECT doc_id, i, parts[i] AS part FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM raw)),
texts AS (SELECT doc_id, string_agg(part, chr(10) ORDER BY i) AS text FROM pieces WHERE NOT EXISTS (SELECT 1 FROM judged j WHERE j.drop AND j.doc_id = pieces.doc_id AND j.line = pieces.i - 1) GROUP BY doc_id),
out AS (SELECT raw.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, CASE WHEN raw.text IS NOT NULL THEN coalesce(texts.text, '') END AS text FROM raw LEFT JOIN counts USING (doc_id) LEFT JOIN texts USING (doc_id))
SELECT doc_id, n_lines, n_removed, length(text) AS n_chars_left, sha256(text) AS text_sha256 FROM out
"""

LEAKS = f"""
WITH d AS (SELECT doc_id, {_words("text", _ALNUM)} AS w FROM documents),
b AS (SELECT item_id, {_words("text", _ALNUM)} AS w FROM benchmark),
g AS (SELECT item_id, least(10, len(w)) AS n, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
k AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM g),
p AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM k) WHERE len(w) >= n),
h AS (SELECT doc_id, p.n, i, item_id FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM p) p JOIN k ON p.n = k.n AND p.s = k.s),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY doc_id),
named AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM named GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _weight(level: str) -> str:
    return "CASE " + level + "".join(f" WHEN '{k}' THEN {w}" for k, w in WEIGHTS[level].items()) + " ELSE 1 END"


def _divided(name: str, nodes: str, parent: str, key: str) -> str:
    """Common table expressions that end in ``name``: ``nodes`` (parent, key, capacity, weight, pool) with a budget."""
    order = f"PARTITION BY {parent} ORDER BY CAST(capacity AS DOUBLE) / weight, {key}"
    return f"""
{name}_1 AS (SELECT *, CAST(coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS HUGEINT) AS used, CAST(sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS HUGEINT) AS rest FROM ({nodes})),
{name}_2 AS (SELECT *, capacity * rest <= weight * (pool - used) AS satisfied FROM {name}_1),
{name}_3 AS (SELECT *, min(used) FILTER (NOT satisfied) OVER (PARTITION BY {parent}) AS u, max(rest) FILTER (NOT satisfied) OVER (PARTITION BY {parent}) AS w FROM {name}_2),
{name} AS (SELECT *, CAST(CASE WHEN satisfied THEN capacity ELSE weight * (pool - u) // w END AS BIGINT) AS budget FROM {name}_3)"""


MIXED = rf"""
WITH t AS (SELECT doc_id, lang, source, coalesce(lang, '') AS l, coalesce(source, '') AS s, coalesce(TRY_CAST(regexp_extract(source, '[0-9]+$') AS INT), 0) AS n, CAST(len(regexp_extract_all(coalesce(text, ''), '{_NONSPACE}')) AS BIGINT) AS tokens FROM documents),
docs AS (SELECT *, CASE WHEN n = 0 THEN 'web' WHEN n < 10 THEN 'reference' ELSE 'community' END AS domain, coalesce(CAST(doc_id AS VARCHAR), '') AS k FROM t WHERE tokens > 0),
leaves AS (SELECT domain, l AS lang, s AS source, CAST(sum(tokens) AS HUGEINT) AS tokens, CAST(2 * sum(tokens) AS HUGEINT) AS capacity FROM docs GROUP BY ALL),
langs AS (SELECT domain, lang, CAST(sum(capacity) AS HUGEINT) AS capacity FROM leaves GROUP BY ALL),
{_divided("top", f"SELECT 0 AS root, domain, CAST(sum(capacity) AS HUGEINT) AS capacity, {_weight('domain')} AS weight, (SELECT sum(tokens) FROM leaves) AS pool FROM langs GROUP BY domain", "root", "domain")},
{_divided("mid", f"SELECT domain, lang, langs.capacity, {_weight('lang')} AS weight, top.budget AS pool FROM langs JOIN top USING (domain)", "domain", "lang")},
{_divided("low", f"SELECT domain, lang, source, tokens, leaves.capacity, {_weight('source')} AS weight, mid.budget AS pool FROM leaves JOIN mid USING (domain, lang)", "domain, lang", "source")},
placed AS (SELECT docs.*, low.tokens AS leaf, budget, unnest(range(0, (budget - 1) // CAST(low.tokens AS BIGINT) + 1)) AS epoch FROM docs JOIN low ON docs.domain = low.domain AND docs.l = low.lang AND docs.s = low.source WHERE budget > 0),
hashed AS (SELECT *, md5('17:' || CAST(epoch AS VARCHAR) || ':' || k) AS h FROM placed),
keyed AS (SELECT domain, l, s, epoch, h, k, sum(tokens) AS t FROM hashed GROUP BY ALL),
before AS (SELECT *, coalesce(sum(t) OVER (PARTITION BY domain, l, s ORDER BY epoch, h, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM keyed)
SELECT doc_id, hashed.epoch, hashed.domain, lang, source, hashed.tokens AS n_tokens, budget AS leaf_budget FROM hashed JOIN before USING (domain, l, s, epoch, h, k) WHERE b < budget
"""

VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0),
fine AS (SELECT * FROM v WHERE vec_id IN (SELECT vec_id FROM (SELECT vec_id, unnest(e) AS x FROM v) GROUP BY vec_id HAVING count(*) = count(x) AND bool_and(isfinite(x)) AND bool_or(x <> 0))),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
{_ROOTS}, degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) IS NOT DISTINCT FROM vec_id AS kept
FROM embeddings LEFT JOIN degree USING (vec_id) LEFT JOIN roots ON node = vec_id
"""

NEAR = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words("text", _NONSPACE)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 0) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
{_ROOTS}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id, coalesce(root, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN roots ON node = d.doc_id
"""


_LINK = r"""(?i)(?:href|src)\s*=\s*["'']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s<>]+)"""
_LOWER = f"'{UPPER}', '{LOWER}'"

URLS = rf"""
WITH RECURSIVE rules(verdict, rule_host, rule_path) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)}),
cut AS (SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, html, translate(h, {_LOWER}) AS host, regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM (SELECT *, regexp_extract(rest, '^[^/?#]*') AS h FROM cut)),
hosts AS (SELECT DISTINCT host FROM p WHERE host <> ''),
domains AS (SELECT DISTINCT host, array_to_string(labels[i:len(labels)], '.') AS domain FROM (SELECT host, string_split(host, '.') AS labels, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM hosts)),
parents AS (SELECT DISTINCT domain AS src, regexp_replace(domain, '^[^.]*\.', '') AS dst FROM domains WHERE contains(domain, '.')),
linked AS (SELECT host AS src, translate(unnest(regexp_extract_all(coalesce(html, ''), '{_LINK}', 1)), {_LOWER}) AS dst FROM p),
edges AS MATERIALIZED (SELECT src, dst, sum(n) AS n FROM (SELECT src, dst, 1.0::DOUBLE AS n FROM linked WHERE src <> '' AND dst <> '' AND src <> dst UNION ALL SELECT src, dst, 1.0 FROM parents UNION ALL SELECT dst, src, 1.0 FROM parents) GROUP BY src, dst),
steps AS MATERIALIZED (SELECT 'trust' AS side, src, dst, n / sum(n) OVER (PARTITION BY src) AS share FROM edges UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM edges),
fit AS MATERIALIZED (SELECT page_id, any_value(host) AS host, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule, max_by(verdict, length(rule_host || rule_path)) AS verdict FROM p JOIN domains USING (host) JOIN rules ON rule_host = domain AND starts_with(path, rule_path) GROUP BY page_id),
seeds AS MATERIALIZED (SELECT CASE verdict WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS side, host, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM fit) AS weight FROM fit GROUP BY ALL),
walk AS (SELECT 0 AS i, side, host, weight AS left_over FROM seeds UNION ALL SELECT i + 1, walk.side, dst, sum({DAMPING}::DOUBLE * left_over * share) FROM walk JOIN steps ON steps.side = walk.side AND src = host WHERE i < {steps_of()} GROUP BY ALL),
raw AS (SELECT side, host, sum(CASE WHEN i < {steps_of()} THEN (1 - {DAMPING}::DOUBLE) * left_over ELSE left_over END) AS score FROM walk GROUP BY ALL),
scores AS (SELECT side, host, score * (SELECT sum(weight) FROM seeds s WHERE s.side = raw.side) / sum(score) OVER (PARTITION BY side) AS score FROM raw),
known AS (SELECT host, coalesce(sum(score) FILTER (side = 'trust'), 0) AS trust, coalesce(sum(score) FILTER (side = 'distrust'), 0) AS distrust FROM scores GROUP BY host),
page AS (SELECT p.page_id, p.host, p.path, fit.rule, fit.verdict, coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust FROM p LEFT JOIN fit USING (page_id) LEFT JOIN known ON known.host = p.host AND p.host <> '')
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN distrust - trust > {TIE}::DOUBLE * greatest(distrust, trust) THEN 'block' ELSE 'allow' END) AS verdict, round(trust, 9) AS trust, round(distrust, 9) AS distrust FROM page
"""

_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

DIVERGENCE = rf"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_words("text", _TERM)} AS w FROM documents),
words AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
kept AS MATERIALIZED (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
found AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM words GROUP BY ALL),
grid AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n, k.n AS all_n FROM groups g JOIN kept k USING (lang) LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
shares AS MATERIALIZED (SELECT *, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p, 1 + (1000000000 * (all_n + 5)) // (sum(all_n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS q FROM grid),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

_ROUNDS = range(1, 7)
_FLOOR = "CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS HUGEINT)"

#: Vectors and centroids in long form, a row a component; table a{i} assigns by the centroids of table c{i}.
CENTROIDS = f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
v AS MATERIALIZED (SELECT r, i, CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS HUGEINT) AS x FROM (SELECT r, embedding, unnest(range(1, 65)) AS i FROM kept)),
first AS (SELECT r, row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)) NULLS LAST, embedding) - 1 AS c FROM kept QUALIFY c < 40),
c1 AS MATERIALIZED (SELECT c, i, x AS y FROM first JOIN v USING (r)),
{",".join(f"""
a{n} AS MATERIALIZED (SELECT r, min(c) AS c, min(d) AS d FROM (SELECT r, c, sum((x - y) * (x - y)) AS d FROM v JOIN c{n} USING (i) GROUP BY r, c QUALIFY d = min(d) OVER (PARTITION BY r)) GROUP BY r),
s{n} AS (SELECT c, i, {_FLOOR} AS y FROM a{n} JOIN v USING (r) GROUP BY c, i),
c{n + 1} AS MATERIALIZED (SELECT o.c, o.i, coalesce(s.y, o.y) AS y FROM c{n} o LEFT JOIN s{n} s ON s.c = o.c AND s.i = o.i)""" for n in _ROUNDS)},
names AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c6 GROUP BY c)
SELECT vec_id, CAST(c AS INT) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a6 JOIN kept USING (r) JOIN names USING (c)
"""

SQL = {"op2_line_dedup": LINES, "op3_decontaminate": LEAKS, "op4_mixing": MIXED, "op5_embed_dedup": VECTORS, "op8_url_filter": URLS, "op9_minhash": NEAR, "op11_divergence": DIVERGENCE, "op12_centroids": CENTROIDS}
