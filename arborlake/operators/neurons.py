"""Properties of whole neurons, computed for all of them at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import trees

# The tags of an end that is not open, and the least radius of a soma in nanometres.
CLOSED = ("ends", "uncertain end", "uncertain continuation", "not a branch", "soma")
SOMA_RADIUS = 500.0


def open_ends(nodes: DataFrame, tags: DataFrame) -> DataFrame:
    """Ends (node_id) that no tag (node_id, tag) declares closed."""
    closed = tags.where(F.col("tag").isin(*CLOSED)).select("node_id").distinct()
    return trees.classify(nodes).where("type = 'end'").select("node_id").join(closed, "node_id", "left_anti")


def somas(nodes: DataFrame, tags: DataFrame, nm_per_unit: float = 1.0) -> DataFrame:
    """Nodes that are thick enough and carry the tag of a soma."""
    tagged = tags.where("tag = 'soma'").select("node_id").distinct()
    return nodes.where(F.col("radius") * nm_per_unit >= SOMA_RADIUS).join(tagged, "node_id", "left_semi")


def gap_junctions(links: DataFrame, relation: str = "relation") -> DataFrame:
    """Links whose relation names a gap junction, or has its number."""
    kind = F.col(relation).cast("string")
    return links.where(F.contains(kind, F.lit("gap")) | (kind == "2"))


def summary(nodes: DataFrame, contacts: DataFrame, by: str) -> DataFrame:
    """Per neuron: nodes, contacts (node_id, a row a contact), branches and leafs. Contacts are counted by node before the join."""
    per = contacts.groupBy("node_id").agg(F.count("*").alias("c"))
    kinds = nodes.select("node_id", by).join(trees.classify(nodes).select("node_id", "type"), "node_id").join(per, "node_id", "left")
    of = lambda t: F.count(F.when(F.col("type") == t, 1))
    return kinds.groupBy(by).agg(F.count("*").alias("n_nodes"), F.coalesce(F.sum("c"), F.lit(0)).alias("n_connectors"), of("branch").alias("n_branches"), of("end").alias("n_leafs"))


def remove_duplicates(neurons: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first neuron, by ``order``, of each combination of ``keys``."""
    first = neurons.groupBy(*keys).agg(F.min_by(F.struct(*neurons.columns), F.struct(*order)).alias("__first"))
    return first.select("__first.*")


def connector_links(connectors: DataFrame, links: DataFrame, ids: DataFrame) -> DataFrame:
    """All links of the neurons ``ids`` (id): connector, neuron and relation."""
    wanted = ids.select("id").distinct()
    pre = connectors.select("connector_id", F.col("pre").cast("long").alias("id"), F.lit("presynaptic_to").alias("relation"))
    post = links.select("connector_id", F.col("post").cast("long").alias("id"), F.lit("postsynaptic_to").alias("relation"))
    return pre.unionByName(post).join(wanted, "id", "left_semi").select("connector_id", "id", "relation")


def user_annotations(links: DataFrame) -> DataFrame:
    """Per user and annotation of ``links`` (user_id, annotation): how often it was used."""
    return links.groupBy("user_id", "annotation").agg(F.count("*").alias("times_used"))


def connector_tags(tags: DataFrame) -> DataFrame:
    """Per tag of ``tags`` (connector_id, tag): its connectors in order."""
    return tags.groupBy("tag").agg(F.array_sort(F.collect_set("connector_id")).alias("connectors"))
