"""Groups of linked records: connected components by label passing, all of it distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.session import cut_lineage

MOST_ROUNDS = 60  # a guard against a wrong graph, not a cap: labels jump, so rounds grow as the logarithm of the diameter


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, grp)`` for every node of a link; grp is the least node of its component.

    Null ends, loops and repeated links are ignored; no links give no rows. Each round takes the least label among a node and
    its neighbours, then the label of that label; rounds end when none changes. Labels and links stay distributed and are
    checkpointed each round; a hub's messages are reduced to one minimum before the shuffle.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    both = cut_lineage(pairs.union(pairs.select("v", "u")).distinct())
    labels = cut_lineage(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("grp")))
    for _ in range(MOST_ROUNDS):
        heard = both.join(labels.select(F.col("node").alias("v"), "grp"), "v").groupBy(F.col("u").alias("node")).agg(F.min("grp").alias("near"))
        nearer = labels.join(heard, "node").select("node", F.col("grp").alias("was"), F.least("grp", "near").alias("grp"))
        jumped = nearer.join(labels.select(F.col("node").alias("grp"), F.col("grp").alias("far")), "grp", "left").select(
            "node", "was", F.least(F.col("grp"), F.coalesce("far", "grp")).alias("grp")
        )
        step = cut_lineage(jumped)
        labels = step.select("node", "grp")
        if step.where(F.col("was") != F.col("grp")).isEmpty():
            return labels
    raise RuntimeError("labels did not settle")
