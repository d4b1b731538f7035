"""Connected components over a table of links, by contraction.

Each round lets every node point to its smallest neighbour, follows these pointers to
their ends and contracts the links to what remains, so a round at least halves the nodes
that still have links. Every step is a shuffle join or a partial aggregation; nothing
about the graph reaches the driver but counts.

A node is any value that can be ordered. Nulls in links, loops and repeated links change nothing;
without links the result is empty. Columns other than a and b are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node reachable."""
    links = scratch.keep(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    made, rest = [links], links
    found = None
    while not rest.isEmpty():
        both = rest.select(F.col("b").alias("node"), F.col("a").alias("to")).unionByName(rest.select(F.col("a").alias("node"), F.col("b").alias("to")))
        up = scratch.keep(both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("root")), "pointers")
        while True:
            made.append(up)
            far = up.select(F.col("node").alias("root"), F.col("root").alias("far"))
            up = scratch.keep(up.join(far, "root").select("node", F.col("far").alias("root"), (F.col("far") != F.col("root")).alias("moved")), "pointers")
            if up.where("moved").isEmpty():
                break
        made.append(up)
        up = up.select("node", "root")
        a, b = up.select(F.col("node").alias("a"), F.col("root").alias("ra")), up.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        rest = scratch.keep(rest.join(a, "a").join(b, "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        made.append(rest)
        if found is not None:
            # a node whose root stayed unlinked in this round keeps it
            up = found.join(up.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        found = scratch.keep(up, "components")
        made.append(found)
    if found is None:
        found = scratch.keep(links.select(F.col("a").alias("node"), F.col("b").alias("root")), "components")
    scratch.drop(*[t for t in made if t is not found])
    return found
