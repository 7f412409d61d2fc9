"""Connected components of a link table, as repeated joins over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(src, dst)``; root is the smallest node reachable.

    Every round hooks each node's root to the smallest root among its links and then halves the
    paths to the roots, so rounds grow with the logarithm of the longest chain. Hot nodes only
    feed minima, which are combined before the exchange. Lost executors cost no more than the
    round in hand, as every round ends in a table.
    """
    both = links.select("src", "dst").union(links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst").distinct()
    both = materialize(both, "links")
    labels = both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low")).select("node", F.least("node", "low").alias("root"))
    labels = materialize(labels, "labels")
    while True:
        ends = both.join(labels, both["dst"] == labels["node"]).select("src", F.col("root").alias("near"))
        low = ends.groupBy("src").agg(F.min("near").alias("near"))
        # the root of a node hears of the smallest root next to the node
        own = labels.join(low, labels["node"] == low["src"]).select("node", "root", F.least("root", "near").alias("low"))
        heard = own.select(F.col("root").alias("at"), "low").union(own.select(F.col("node").alias("at"), "low"))
        heard = heard.groupBy("at").agg(F.min("low").alias("low"))
        hooked = materialize(labels.join(heard, labels["node"] == heard["at"]).select("node", F.least("root", "low").alias("root")), "hooked")
        above = hooked.select(F.col("node").alias("up"), F.col("root").alias("top"))
        jumped = hooked.join(above, hooked["root"] == above["up"]).select("node", F.least("root", "top").alias("root"))
        before, labels = labels, materialize(jumped, "labels")
        changed = before.select("node", F.col("root").alias("was")).join(labels, "node").where("was <> root")
        if changed.isEmpty():
            return labels
