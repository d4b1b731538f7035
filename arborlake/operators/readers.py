"""Readers of neurons, nodes, volumes and provenance: joins and filters over the canonical tables.

Tables: nodes (node_id, parent_id, skeleton_id, x, y, z, radius, confidence, creator_id, editor_id,
created, edited), reviews (node_id, reviewer_id, reviewed), tags (label_id, tag, node_id, kind, where kind is
node or connector), users (user_id, login, full_name, first_name, last_name), skeletons (skeleton_id, neuron_id,
name), connectors (connector_id, x, y, z, creator_id, created), links (connector_id, node_id, skeleton_id,
relation, confidence). Lists of ids come as tables of one column, so they may be of any length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import trees

# Nanometres of a pixel in the plane and between sections.
PIXEL = (4.0, 4.0, 40.0)


def _only(df: DataFrame, ids: DataFrame | None, key: str) -> DataFrame:
    """Rows whose ``key`` is in ``ids`` (a column of that name); all rows where no ids are given."""
    return df if ids is None else df.join(ids.select(key).distinct(), key, "left_semi")


def box_in_nm(box: tuple[tuple, tuple], unit: str = "NM", resolution: tuple[float, float, float] = PIXEL) -> tuple[tuple, tuple]:
    """Lower and upper corner in nanometres."""
    if unit not in ("NM", "PIXEL"):
        raise ValueError("unit is NM or PIXEL")
    scale = resolution if unit == "PIXEL" else (1.0, 1.0, 1.0)
    return tuple(tuple(v * s for v, s in zip(corner, scale)) for corner in box)


def inside(box: tuple[tuple, tuple]) -> Column:
    return reduce(Column.__and__, [F.col(c).between(a, b) for c, a, b in zip("xyz", *box)])


def list_of_reviews(reviews: DataFrame) -> DataFrame:
    """(node_id, reviewers, review_times) in order of time."""
    both = F.array_sort(F.collect_set(F.struct("reviewed", "reviewer_id")))
    out = reviews.groupBy("node_id").agg(both.alias("r"))
    return out.select("node_id", F.transform("r", lambda r: r["reviewer_id"]).alias("reviewers"), F.transform("r", lambda r: r["reviewed"]).alias("review_times"))


def _array(c: str, kind: str) -> Column:
    return F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c)


def node_table(nodes: DataFrame, reviews: DataFrame, tags: DataFrame, users: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Nodes of the skeletons ``ids`` (skeleton_id) with the creator's login, all reviewers and all tags."""
    own = _only(nodes, ids, "skeleton_id")
    who = reviews.groupBy("node_id").agg(F.array_sort(F.collect_set("reviewer_id")).alias("reviewers"))
    what = tags.where("kind = 'node'").groupBy("node_id").agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    login = users.select(F.col("user_id").alias("creator_id"), F.col("login").alias("creator"))
    out = own.join(who, "node_id", "left").join(what, "node_id", "left").join(login, "creator_id", "left")
    reviewer = dict(reviews.dtypes)["reviewer_id"]
    return out.select("skeleton_id", "node_id", F.col("parent_id").alias("parent_node_id"), "confidence", "x", "y", "z", "radius", "creator", F.col("edited").alias("last_edited"), _array("reviewers", reviewer), _array("tags", "string"))


def node_details(nodes: DataFrame, reviews: DataFrame, users: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Who made, changed and reviewed the nodes ``ids`` (node_id), and when."""
    own = _only(nodes, ids, "node_id").join(list_of_reviews(reviews), "node_id", "left")
    for side in ("creator", "editor"):
        own = own.join(users.select(F.col("user_id").alias(f"{side}_id"), F.col("login").alias(side)), f"{side}_id", "left")
    kinds = dict(reviews.dtypes)
    return own.select("node_id", F.col("created").alias("creation_time"), "creator", F.col("edited").alias("edition_time"), "editor", _array("reviewers", kinds["reviewer_id"]), _array("review_times", kinds["reviewed"]))


def node_info(nodes: DataFrame, skeletons: DataFrame, ids: DataFrame) -> DataFrame:
    """Skeleton, neuron and name of the nodes ``ids`` (node_id)."""
    return _only(nodes.select("node_id", "skeleton_id"), ids, "node_id").join(skeletons, "skeleton_id").select("node_id", "skeleton_id", "neuron_id", F.col("name").alias("skeleton_name"))


def node_locations(nodes: DataFrame, connectors: DataFrame, ids: DataFrame) -> DataFrame:
    """(pos, node_id, x, y, z) of nodes and connectors in ``ids`` (pos, node_id), by pos."""
    both = nodes.select("node_id", "x", "y", "z").unionByName(connectors.select(F.col("connector_id").alias("node_id"), "x", "y", "z"))
    return ids.select("pos", "node_id").join(both, "node_id").select("pos", "node_id", "x", "y", "z").orderBy("pos")


def skeletons_of_nodes(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """(node_id, skeleton_id): null where a node is unknown."""
    return ids.select("node_id").distinct().join(nodes.select("node_id", "skeleton_id"), "node_id", "left")


def find_nodes(nodes: DataFrame, tags: DataFrame, wanted: list[str] | None = None, node_ids: DataFrame | None = None, skeleton_ids: DataFrame | None = None) -> DataFrame:
    """Nodes that carry any of the tags, are in ``node_ids`` and belong to ``skeleton_ids``; what isn't given isn't asked for."""
    out = _only(_only(nodes, node_ids, "node_id"), skeleton_ids, "skeleton_id")
    if wanted is not None:
        out = _only(out, tags.where((F.col("kind") == "node") & F.col("tag").isin(wanted)), "node_id")
    return out


def in_box(nodes: DataFrame, connectors: DataFrame, box: tuple[tuple, tuple], unit: str = "NM", resolution: tuple[float, float, float] = PIXEL) -> DataFrame:
    """(kind, id, skeleton_id, x, y, z): nodes and connectors in a box."""
    ok = inside(box_in_nm(box, unit, resolution))
    own = nodes.where(ok).select(F.lit("node").alias("kind"), F.col("node_id").alias("id"), "skeleton_id", "x", "y", "z")
    other = connectors.where(ok).select(F.lit("connector").alias("kind"), F.col("connector_id").alias("id"), F.lit(None).cast(dict(nodes.dtypes)["skeleton_id"]).alias("skeleton_id"), "x", "y", "z")
    return own.unionByName(other)


def page_of_box(found: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows of a box by kind and id, with ``more``: whether that left some out."""
    rows = found.orderBy("kind", "id").limit(limit + 1)
    total = rows.agg((F.count("*") > limit).alias("more"))
    return rows.orderBy("kind", "id").limit(limit).join(F.broadcast(total), F.lit(True))  # one row


def tags_of(tags: DataFrame, kind: str, ids: DataFrame | None = None) -> DataFrame:
    """(node_id, tags) of nodes, or of connectors."""
    return _only(tags.where(F.col("kind") == kind), ids, "node_id").groupBy("node_id").agg(F.array_sort(F.collect_set("tag")).alias("tags"))


def label_list(tags: DataFrame, nodes: DataFrame) -> DataFrame:
    """(label_id, tag, skeleton_id, node_id) of all tagged nodes."""
    return tags.where("kind = 'node'").join(nodes.select("node_id", "skeleton_id"), "node_id").select("label_id", "tag", "skeleton_id", "node_id")


def names(skeletons: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    return _only(skeletons, ids, "skeleton_id").select("skeleton_id", "name").distinct()


def neuron_ids(skeletons: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    return _only(skeletons, ids, "skeleton_id").select("skeleton_id", "neuron_id").distinct()


def exists(skeletons: DataFrame, ids: DataFrame) -> DataFrame:
    """(skeleton_id, exists) for each of ``ids``."""
    known = skeletons.select("skeleton_id", F.lit(True).alias("exists")).distinct()
    return ids.select("skeleton_id").distinct().join(known, "skeleton_id", "left").select("skeleton_id", F.coalesce("exists", F.lit(False)).alias("exists"))


def import_info(nodes: DataFrame, with_nodes: bool = False) -> DataFrame:
    """Per skeleton its nodes and imported ones (``imported``), on demand with these."""
    out = [F.count("*").alias("n_nodes"), F.count_if("imported").alias("n_imported")]
    if with_nodes:
        out.append(F.array_sort(F.collect_list(F.when(F.col("imported"), F.col("node_id")))).alias("imported_nodes"))
    return nodes.groupBy("skeleton_id").agg(*out)


def origins(origin: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Provenance (skeleton_id, source_id, source_url, source_project_id) of skeletons."""
    return _only(origin, ids, "skeleton_id").select("skeleton_id", "source_id", "source_url", "source_project_id")


def skeletons_by_origin(origin: DataFrame, source_ids: DataFrame, url: str, project: int) -> DataFrame:
    """(source_id, skeleton_id) of sources of one url and project."""
    return _only(origin.where((F.col("source_url") == url) & (F.col("source_project_id") == project)), source_ids, "source_id").select("source_id", "skeleton_id")


def skeleton_changes(history: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Splits and merges: nodes by their old and new skeleton, with the first and last time. history: node_id, skeleton_id, new_skeleton_id, changed."""
    own = _only(history, ids, "skeleton_id").where("skeleton_id <> new_skeleton_id")
    return own.groupBy("skeleton_id", "new_skeleton_id").agg(F.count("*").alias("n_nodes"), F.min("changed").alias("first"), F.max("changed").alias("last"))


def skeletons_in_box(nodes: DataFrame, box: tuple[tuple, tuple], unit: str = "NM", min_nodes: int = 1, min_cable: float = 1.0) -> DataFrame:
    """(skeleton_id, n_nodes, cable) of skeletons with enough nodes and cable in a box. An edge belongs to its lower node; the parent may be outside."""
    own = trees.with_length(nodes).where(inside(box_in_nm(box, unit)))
    return own.groupBy("skeleton_id").agg(F.count("*").alias("n_nodes"), F.sum("length").alias("cable")).where((F.col("n_nodes") >= min_nodes) & (F.col("cable") >= min_cable))


def skeletons_in_volumes(nodes: DataFrame, volumes: list[tuple[tuple, tuple]], min_nodes: int = 2, min_cable: float = 1.0, intersect: bool = False, somas: DataFrame | None = None) -> DataFrame:
    """(skeleton_id) in the bounding boxes of any, or of all volumes; ``somas`` (skeleton_id) keeps those with a soma. All boxes are checked in one pass."""
    own = trees.with_length(nodes)
    hit = F.array_compact(F.array(*[F.when(inside(v), F.lit(i)) for i, v in enumerate(volumes)]))
    per = own.select("skeleton_id", "length", F.explode(hit).alias("volume")).groupBy("skeleton_id", "volume").agg(F.count("*").alias("n"), F.sum("length").alias("cable"))
    out = per.where((F.col("n") >= min_nodes) & (F.col("cable") >= min_cable)).groupBy("skeleton_id").agg(F.count("*").alias("k")).where(F.col("k") >= (len(volumes) if intersect else 1))
    return _only(out.select("skeleton_id"), somas, "skeleton_id")


def skeleton_ids(nodes: DataFrame, reviews: DataFrame | None = None, created_by: int | None = None, reviewed_by: int | None = None, since: str | None = None, until: str | None = None, nodecount_gt: int | None = None) -> DataFrame:
    """(skeleton_id) by creator, reviewer and creation of their nodes; ``nodecount_gt`` cancels all other criteria."""
    if nodecount_gt is not None:
        return nodes.groupBy("skeleton_id").agg(F.count("*").alias("n")).where(F.col("n") > nodecount_gt).select("skeleton_id")
    if created_by is not None:
        nodes = nodes.where(F.col("creator_id") == created_by)
    if since is not None:
        nodes = nodes.where(F.col("created") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        nodes = nodes.where(F.col("created") < F.lit(until).cast("timestamp_ntz"))
    if reviewed_by is not None:
        nodes = _only(nodes, reviews.where(F.col("reviewer_id") == reviewed_by), "node_id")
    return nodes.select("skeleton_id").distinct()


def has_soma(nodes: DataFrame, tags: DataFrame, ids: DataFrame, tag: str = "soma", min_radius: float = 500.0, return_ids: bool = False) -> DataFrame:
    """(skeleton_id, has_soma), or (skeleton_id, somas) with the nodes: thick enough and tagged; False or none for the others of ``ids``."""
    found = _only(nodes.where(F.col("radius") >= min_radius), tags.where((F.col("kind") == "node") & (F.col("tag") == tag)), "node_id")
    per = found.groupBy("skeleton_id").agg(F.array_sort(F.collect_set("node_id")).alias("somas"))
    out = ids.select("skeleton_id").distinct().join(per, "skeleton_id", "left")
    if return_ids:
        return out.select("skeleton_id", _array("somas", dict(nodes.dtypes)["node_id"]))
    return out.select("skeleton_id", F.col("somas").isNotNull().alias("has_soma"))


def user_list(users: DataFrame) -> DataFrame:
    """Users by login and id; a missing full name is made of the others, and a missing part is empty."""
    part = lambda c: F.coalesce(c, F.lit(""))
    full = F.coalesce(F.nullif("full_name", F.lit("")), F.trim(F.concat_ws(" ", part("first_name"), part("last_name"))))
    return users.select("user_id", "login", full.alias("full_name"), part("first_name").alias("first_name"), part("last_name").alias("last_name")).orderBy("login", "user_id")


def transactions(log: DataFrame, users: DataFrame, start: int = 0, length: int = 25) -> DataFrame:
    """A page of transactions (transaction_id, user_id, label, executed), newest first, with logins."""
    page = log.orderBy(F.desc("executed"), F.desc("transaction_id")).offset(start).limit(length)
    return page.join(users.select("user_id", "login"), "user_id", "left").select("transaction_id", "login", "label", "executed")


def samplers(sampler: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Samplers, with their times as timestamps (from seconds)."""
    return _only(sampler, ids, "skeleton_id").withColumn("created", F.timestamp_seconds("created"))


def sampler_domains(domains: DataFrame, sampler_id: int) -> DataFrame:
    return domains.where(F.col("sampler_id") == sampler_id)


def sampler_counts(sampler: DataFrame, ids: DataFrame) -> DataFrame:
    """(skeleton_id, n) for each of ``ids``, 0 without a sampler."""
    per = sampler.groupBy("skeleton_id").agg(F.count("*").alias("n"))
    return ids.select("skeleton_id").distinct().join(per, "skeleton_id", "left").select("skeleton_id", F.coalesce("n", F.lit(0)).alias("n"))


def neuron_nodes(nodes: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Nodes of skeletons as their table has them: a root's parent is -1."""
    own = _only(nodes, ids, "skeleton_id")
    return own.select("skeleton_id", "node_id", F.coalesce("parent_id", F.lit(-1)).alias("parent_id"), "creator_id", "x", "y", "z", "radius", "confidence")


def neuron_connectors(links: DataFrame, connectors: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Links of skeletons with the connector's place and the kind as a number."""
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in zip(("presynaptic_to", "postsynaptic_to", "gapjunction_with", "abutting"), range(4)) for x in pair]), F.col("relation"))
    return _only(links, ids, "skeleton_id").join(connectors.select("connector_id", "x", "y", "z"), "connector_id").select("skeleton_id", "node_id", "connector_id", kind.alias("type"), "x", "y", "z")


def neurons(nodes: DataFrame, links: DataFrame, connectors: DataFrame, tags: DataFrame, skeletons: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """A row a neuron: name, nodes, connectors and tagged nodes as arrays of structs, which one neuron's data bounds; flat tables are ``neuron_nodes`` and ``neuron_connectors``."""
    own = neuron_nodes(nodes, ids)
    parts = own.groupBy("skeleton_id").agg(F.array_sort(F.collect_list(F.struct(*[c for c in own.columns if c != "skeleton_id"]))).alias("nodes"))
    cn = neuron_connectors(links, connectors, ids)
    cn = cn.groupBy("skeleton_id").agg(F.array_sort(F.collect_list(F.struct(*[c for c in cn.columns if c != "skeleton_id"]))).alias("connectors"))
    tagged = tags.where("kind = 'node'").join(own.select("node_id", "skeleton_id"), "node_id")
    tagged = tagged.groupBy("skeleton_id").agg(F.array_sort(F.collect_set(F.struct("tag", "node_id"))).alias("tags"))
    name = _only(skeletons, ids, "skeleton_id").select("skeleton_id", "name")
    return name.join(parts, "skeleton_id").join(cn, "skeleton_id", "left").join(tagged, "skeleton_id", "left")


def missing(skeletons: DataFrame, ids: DataFrame) -> DataFrame:
    """(skeleton_id): those of ``ids`` that don't exist."""
    return ids.select("skeleton_id").distinct().join(skeletons.select("skeleton_id"), "skeleton_id", "left_anti")


def arbor_partners(links: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per link of a skeleton each other link of its connector: this node and relation, and the other ones'."""
    own = _only(links, ids, "skeleton_id").select("connector_id", "node_id", "skeleton_id", "relation")
    other = links.select("connector_id", *[F.col(c).alias(f"other_{c}") for c in ("node_id", "skeleton_id", "relation")])
    return own.join(other, "connector_id").where("node_id <> other_node_id")


def user_history(nodes: DataFrame, links: DataFrame, reviews: DataFrame, since: str, until: str) -> DataFrame:
    """(user_id, day, cable, n_nodes, n_links, n_reviewed): what users did on each day of a period, whose last day is excluded. links: creator_id, created."""
    day = lambda df, ts: df.where((F.col(ts) >= F.lit(since).cast("timestamp_ntz")) & (F.col(ts) < F.lit(until).cast("timestamp_ntz")))
    none = lambda *cs: [F.lit(0).cast("double" if c == "cable" else "long").alias(c) for c in cs]
    made = day(trees.with_length(nodes), "created").groupBy(F.col("creator_id").alias("user_id"), F.to_date("created").alias("day")).agg(F.sum("length").alias("cable"), F.count("*").alias("n_nodes")).select("*", *none("n_links", "n_reviewed"))
    linked = day(links, "created").groupBy(F.col("creator_id").alias("user_id"), F.to_date("created").alias("day")).agg(F.count("*").alias("n_links")).select("*", *none("cable", "n_nodes", "n_reviewed"))
    seen = day(reviews, "reviewed").groupBy(F.col("reviewer_id").alias("user_id"), F.to_date("reviewed").alias("day")).agg(F.count("*").alias("n_reviewed")).select("*", *none("cable", "n_nodes", "n_links"))
    rows = made.unionByName(linked).unionByName(seen)
    return rows.groupBy("user_id", "day").agg(*[F.sum(c).alias(c) for c in ("cable", "n_nodes", "n_links", "n_reviewed")])


def user_totals(nodes: DataFrame, links: DataFrame, reviews: DataFrame, since: str, until: str) -> DataFrame:
    """The sums of ``user_history`` per user, most nodes first."""
    days = user_history(nodes, links, reviews, since, until)
    return days.groupBy("user_id").agg(*[F.sum(c).alias(c) for c in ("cable", "n_nodes", "n_links", "n_reviewed")]).orderBy(F.desc("n_nodes"), "user_id")


def user_actions(nodes: DataFrame, links: DataFrame, reviews: DataFrame, users: DataFrame, who: DataFrame | None = None, skeletons: DataFrame | None = None) -> DataFrame:
    """(user, timestamp, action): creation, edition (more than 0.2 s after), review and linking of nodes, by time."""
    own = _only(nodes, skeletons, "skeleton_id")
    made = own.select(F.col("creator_id").alias("user_id"), F.col("created").alias("timestamp"), F.lit("creation").alias("action"))
    late = F.expr("timestampdiff(MICROSECOND, created, edited) > 200000")
    changed = own.where(late).select(F.col("editor_id").alias("user_id"), F.col("edited").alias("timestamp"), F.lit("edition").alias("action"))
    seen = _only(reviews, own if skeletons is not None else None, "node_id").select(F.col("reviewer_id").alias("user_id"), F.col("reviewed").alias("timestamp"), F.lit("review").alias("action"))
    linked = _only(links, skeletons, "skeleton_id").select(F.col("creator_id").alias("user_id"), F.col("created").alias("timestamp"), F.lit("linking").alias("action"))
    rows = reduce(DataFrame.unionByName, [made, changed, seen, linked])
    rows = _only(rows, who, "user_id").join(users.select("user_id", F.col("login").alias("user")), "user_id")
    return rows.select("user", "timestamp", "action").orderBy("timestamp", "user", "action")


def review_details(reviews: DataFrame, nodes: DataFrame, users: DataFrame, reviewers: list[int]) -> DataFrame:
    """(node_id, skeleton_id) with a column for each of the given reviewers: when they reviewed the node last."""
    rows = reviews.where(F.col("reviewer_id").isin(reviewers)).join(nodes.select("node_id", "skeleton_id"), "node_id")
    return rows.groupBy("node_id", "skeleton_id").pivot("reviewer_id", reviewers).agg(F.max("reviewed"))
