"""Connected components by alternating large-star and small-star steps, with DataFrame operations only.

Each step is one aggregation (a map-side minimum per node) and one join back, so a node with very many
links costs no more per task than its share of the rows. Lineage is cut after each round by a table
written to the shared scratch folder.
"""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, unmeasured


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One step over links (node, other). Large-star: every node links its larger neighbours to its
    smallest neighbour or itself; small-star: its smaller ones."""
    least = links.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("least"))
    kept = links.where(F.col("other") > F.col("node") if larger else F.col("other") < F.col("node"))
    moved = kept.join(unmeasured(least), "node").select(F.col("other").alias("node"), F.col("least").alias("other"))
    if not larger:  # the node itself hangs below its smallest neighbour too
        moved = moved.unionByName(least.select("node", F.col("least").alias("other")))
    return moved.where("node <> other").distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every value met in ``left`` or ``right``: the smallest value reachable from it.

    Rows with a null end and loops are ignored; repeated links count once. An empty input gives an empty result.
    """
    ends = links.select(F.col(left).alias("node"), F.col(right).alias("other")).where("node <> other")
    current = materialize(ends.select(F.greatest("node", "other").alias("node"),
                                      F.least("node", "other").alias("other")).distinct(), "links")
    seen = current.count()
    state = None
    while seen:
        both = current.unionByName(current.select(F.col("other").alias("node"), F.col("node").alias("other")))
        after_large = _star(both, larger=True)
        current = materialize(_star(after_large, larger=False), "links")
        row = current.agg(F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    return current.select("node", F.col("other").alias("root")).unionByName(
        current.select(F.col("other").alias("node"), F.col("other").alias("root")).distinct())
