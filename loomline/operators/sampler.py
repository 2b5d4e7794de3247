"""The diversity sampler: most picks are without replacement until a tool's intents are used up.

A row is fresh with probability 0.8. The k-th fresh row of a tool, k up to its number of intents n, takes item k of the tool's seeded
permutation; all other rows pick any intent. Only rows before the n-th fresh one need an order, so the running count covers
a prefix of ids in which each tool with intents is used up, or all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.functions.draws import pick, uniform
from loomline.sources import dimensions

FRESH = 0.8


def permutation(intents: DataFrame, seeds: DataFrame) -> DataFrame:
    """dataset, tool_name, k (from 1), idx: the order in which a dataset's fresh rows use a tool's intents."""
    key = F.md5(F.concat_ws("|", F.col("seed").cast("string"), F.lit("perm"), "tool_name", F.col("idx").cast("string")).cast("binary"))
    k = F.row_number().over(Window.partitionBy("dataset", "tool_name").orderBy(key, "idx"))
    return intents.select("tool_name", "idx").crossJoin(F.broadcast(seeds)).withColumn("k", k).select("dataset", "tool_name", "k", "idx")


def enough_prefix(marked: DataFrame, rows: int, first: int) -> int:
    """The least of first, 4 * first, 16 * first, ... before which each tool with intents has used all of them up in every dataset, or rows: one pass over the draws."""
    steps = [first]
    while steps[-1] < rows:
        steps.append(steps[-1] * 4)
    used = [F.count_if((F.col("id") < p) & F.col("fresh")).alias(f"p{i}") for i, p in enumerate(steps)]
    missing = marked.where("n IS NOT NULL").groupBy("dataset", "tool_name").agg(F.first("n").alias("n"), *used).agg(*[F.count_if(F.col(f"p{i}") < F.col("n")).alias(f"p{i}") for i in range(len(steps))]).first()
    return next((p for i, p in enumerate(steps) if not missing[f"p{i}"]), rows)


def with_intents(spark: SparkSession, draws: DataFrame, rows: int, prefix: int = 4096, repair: bool = False) -> DataFrame:
    """draws (dataset, seed, id, tool_name) with fresh_rank, query and arguments; tools without intents get `use <tool>` and {}."""
    intents = dimensions.intents(spark, repair)
    n = intents.groupBy("tool_name").agg(F.count(F.lit(1)).cast("int").alias("n"))
    marked = draws.join(F.broadcast(n), "tool_name", "left").withColumn("fresh", F.col("n").isNotNull() & (uniform("fresh", F.col("seed"), F.col("id")) < FRESH))
    prefix = enough_prefix(marked, rows, prefix) if prefix < rows else prefix
    count = F.sum(F.col("fresh").cast("int")).over(Window.partitionBy("dataset", "tool_name").orderBy("id").rowsBetween(Window.unboundedPreceding, 0))
    head = marked.where(F.col("id") < prefix).withColumn("k", F.when(F.col("fresh"), count))
    tail = marked.where(F.col("id") >= prefix).withColumn("k", F.lit(None).cast("long"))
    order = permutation(intents, draws.select("dataset", "seed").distinct())
    met = head.unionByName(tail).withColumn("k", F.when(F.col("k") <= F.col("n"), F.col("k").cast("int"))).join(F.broadcast(order), ["dataset", "tool_name", "k"], "left")
    met = met.withColumn("idx", F.coalesce("idx", pick(uniform("intent", F.col("seed"), F.col("id")), F.col("n"))))
    return _named(met, intents).withColumnRenamed("k", "fresh_rank").drop("n", "fresh")


def _named(rows: DataFrame, intents: DataFrame) -> DataFrame:
    """rows (tool_name, idx) with query and arguments; `use <tool>` and {} where there are none."""
    out = rows.join(F.broadcast(intents), ["tool_name", "idx"], "left")
    return out.withColumn("query", F.coalesce("query", F.concat(F.lit("use "), "tool_name"))).withColumn("arguments", F.coalesce("arguments", F.lit("{}")))


def with_library_intents(spark: SparkSession, draws: DataFrame) -> DataFrame:
    """draws (seed, id, tool_name) with query and arguments of an intent of the library's own table, each as likely as the others of its tool."""
    intents = dimensions.intents(spark, library=True)
    n = intents.groupBy("tool_name").agg(F.count(F.lit(1)).cast("int").alias("n"))
    met = draws.join(F.broadcast(n), "tool_name", "left").withColumn("idx", pick(uniform("intent", F.col("seed"), F.col("id")), F.col("n")))
    return _named(met, intents).drop("n")
