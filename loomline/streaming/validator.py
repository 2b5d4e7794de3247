"""A stateless file-source stream of the validator: an extension; lines are read as sources.records reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators.validate import strict_json
from loomline.streaming.counts import lines_of


def invalid_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """A streaming DataFrame of assistant and tool messages, of the lines that are records, whose content is not a JSON object."""
    rows = lines_of(spark, folder).select(F.explode("messages").alias("m")).select("m.*")
    return rows.where(F.col("role").isin("assistant", "tool")).withColumn("kind", strict_json("content")).where("kind IS NULL OR kind <> 'object'")


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Process all files that are there, exactly once, and stop."""
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
