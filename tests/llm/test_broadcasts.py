"""Join sides whose size nobody has measured are not broadcast, however small their files look."""
from pyspark.sql import functions as F

from tidemark.llm import components, near_copies, simhash
from tidemark.session import materialize


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_exploded_keys_are_not_broadcast(spark):
    """28 keys per fingerprint: the table behind them takes kilobytes."""
    fps = materialize(spark.range(2000).select(F.xxhash64("id").alias("fp")), "fps")
    text = plan(simhash.near_links(fps, 6))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_links_and_roots_are_not_broadcast(spark):
    links = materialize(spark.range(500).select(F.col("id").alias("node"), (F.col("id") / 2).cast("long").alias("other")), "links")
    assert "Broadcast" not in plan(components._star(links, larger=False))
    nodes = links.select("node")
    rooted = near_copies._with_roots(nodes, links.select(F.col("node").alias("left"), F.col("other").alias("right")))
    assert "Broadcast" not in plan(rooted) and {r.root for r in rooted.collect()} == {0}
