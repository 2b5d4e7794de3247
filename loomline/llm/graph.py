"""Connected components in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import hot_keys, join_groups, staged


def components(edges: DataFrame) -> DataFrame:
    """node, root (the component's smallest node) of every node in edges (a, b: long) but the roots themselves.

    Large-star and small-star steps in turn: neighbours move to the smallest node known, until nothing changes. Each step is joins and
    partial minima over staged edges; the edges of a node that has very many are dealt out over tasks.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    while True:
        e = staged(e, "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = staged(join_groups(both, least, ["a"], hot_keys(both, ["a"], 2 * now[0]), ["b"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        e = join_groups(large, lower, ["a"], hot_keys(large, ["a"], now[0]), ["b"]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lower.select("a", F.col("m").alias("b"))).distinct()
