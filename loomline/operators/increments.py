"""Reports that grow batch by batch: each batch's partial counts are kept as a table, and a report merges them without reading old rows again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a batch leaves behind for each value of each key.
STATE = "batch long, dataset string, dimension string, value string, n long, first_seen long"


def partial_counts(rows: DataFrame, keys: list[str], batch: Column, by: str = "dataset", order: str = "id") -> DataFrame:
    """STATE of the batches in rows: for each value of each key its count and the least order value; a missing value counts as `?`."""
    rows = rows.select(batch.cast("long").alias("batch"), F.col(by).cast("string").alias("dataset"), F.col(order).cast("long").alias("order"), *[F.coalesce(F.col(k).cast("string"), F.lit("?")).alias(f"key{i}") for i, k in enumerate(keys)])
    names = [f"key{i}" for i in range(len(keys))]
    dimension = F.coalesce(*[F.when(F.grouping(n) == 0, F.lit(k)) for n, k in zip(names, keys, strict=True)])
    sets = rows.groupingSets([[F.col("batch"), F.col("dataset"), F.col(n)] for n in names], F.col("batch"), F.col("dataset"), *[F.col(n) for n in names])
    found = sets.agg(dimension.alias("dimension"), F.coalesce(*names).alias("value"), F.count(F.lit(1)).alias("n"), F.min("order").alias("first_seen"))
    return found.select("batch", "dataset", "dimension", "value", "n", "first_seen")


def add_batches(partials: DataFrame, state: str) -> None:
    """Keep the partial counts (with a column batch) in the state folder; a batch that is there already is replaced, so that adding it again changes nothing."""
    partials.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(state)


def merged(spark: SparkSession, state: str) -> DataFrame:
    """dataset, dimension, value, n, first_seen, pct over all batches, as report.distribution() gives them of all rows."""
    kept = spark.read.schema(STATE).parquet(state)
    counts = kept.groupBy("dataset", "dimension", "value").agg(F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"))
    return counts.withColumn("pct", F.col("n") * F.lit(100.0) / F.sum("n").over(Window.partitionBy("dataset", "dimension")))


def compact(spark: SparkSession, state: str, out: str, below: int) -> None:
    """The state in another folder, with all batches below a number as one, numbered below - 1: as many rows as there are values, not times batches."""
    kept = spark.read.schema(STATE).parquet(state)
    whole = F.when(F.col("batch") < below, below - 1).otherwise(F.col("batch")).cast("long").alias("batch")
    counts = kept.groupBy(whole, "dataset", "dimension", "value").agg(F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"))
    counts.write.mode("overwrite").partitionBy("batch").parquet(out)
