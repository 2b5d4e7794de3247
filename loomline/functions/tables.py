"""Tables written to the folder that driver and executors share, and names that clash with no column."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, label: str = "jsonl") -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir), or in a temporary one in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="loomline-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(rows: DataFrame, label: str) -> DataFrame:
    """rows written as Parquet to the shared folder and read back: the lineage is cut, and what depends on how rows were dealt out stays as it is."""
    path = scratch_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
