"""Micro-batches over files of records: reports by batch, and running totals that the stream itself keeps.

Each batch's result is written under its number, so that a batch that runs again after a failure replaces what it had written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomline.operators.increments import add_batches, partial_counts
from loomline.sources import records


def lines_of(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of records.scan()'s rows (line, reason and the record's columns) of the files that come to a folder."""
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return records.scanned_lines(reader.text(folder))


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Hand all that is there, batch by batch, to each(rows, number), and stop; a run from the same checkpoint goes on after the last batch that ended well."""
    query = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def report_batches(stream: DataFrame, keys: list[str], state: str, checkpoint: str, by: str = "dataset", order: str = "id") -> None:
    """Each batch's partial counts into the state folder of operators.increments."""
    run_batches(stream, lambda rows, number: add_batches(partial_counts(rows, keys, F.lit(number), by, order), state), checkpoint)


def total_batches(stream: DataFrame, keys: list[str], sums: dict[str, Column], out: str, checkpoint: str) -> None:
    """Running totals by keys: the stream keeps them in its checkpoint, and each batch writes the ones that it changed, with its number, to out."""
    totals = stream.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])

    def write(rows: DataFrame, number: int) -> None:
        rows.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    run_batches(totals, write, checkpoint, "update")


def latest(totals: DataFrame, keys: list[str]) -> DataFrame:
    """Of what total_batches() wrote, each key's last row."""
    values = [c for c in totals.columns if c not in (*keys, "batch")]
    return totals.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("x")).select(*keys, "x.*")
