"""Seeded shuffle and exact splits by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Leading hash characters that number the buckets: 4,096 of them, whatever the data.
BUCKET_CHARS = 3


def positions(table: DataFrame, key: str, seed: int) -> DataFrame:
    """table with pos, its place (from 0) in the order of md5('seed|key'), then key.

    Rows are numbered within hash buckets; the buckets' sizes, a table of fixed size, give the offsets. No task sees all rows.
    """
    # the row is one struct, so that its columns' names clash with none of these
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    hashed = table.select(F.struct(*table.columns).alias("row"), F.col(key).alias("key"), h.alias("h"), F.substring(h, 1, BUCKET_CHARS).alias("b"))
    sizes = hashed.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("b").orderBy("h", "key")) - 1
    return hashed.withColumn("in", within).join(F.broadcast(starts), "b").select("row.*", (F.col("start") + F.col("in")).cast("long").alias("pos"))


def split_70_15_15(table: DataFrame, key: str, seed: int, total: int | None = None) -> DataFrame:
    """table (its first `total` rows in shuffled order) with pos and split; sizes are int(n * 0.70), int(n * 0.15) and the rest."""
    n = table.count() if total is None else min(total, table.count())
    train, held = int(n * 0.70), int(n * 0.15)
    placed = positions(table, key, seed).where(F.col("pos") < n)
    return placed.withColumn("split", F.when(F.col("pos") < train, "train").when(F.col("pos") < train + held, "eval").otherwise("test"))


def write_splits(rows: DataFrame, path: str) -> None:
    """rows (with split) as a folder for each split that they have; other splits' folders stay as they are."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str, schema: StructType) -> DataFrame:
    """One split's rows; the other folders aren't read. To replace a split with what was read of it, write the rows elsewhere first: a folder can't be read while it is replaced."""
    return spark.read.schema(schema).parquet(path).where(F.col("split") == split)
