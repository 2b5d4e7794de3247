"""Reading JSON Lines that may be damaged: each line is parsed once, by json.loads, into a record or a reason why it is none.

Nothing is dropped in silence: a line is good, blank, or rejected with its reason, its file and its own text.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from loomline.functions.slices import bounded_batches, slices
from loomline.functions.tables import scratch_dir
from loomline.sources.jsonl import RECORD

#: reason: null for a record, `blank`, or what is wrong.
SCAN = T.StructType([T.StructField("record", RECORD), T.StructField("reason", T.StringType())])


def fitted(value: object, kind: T.DataType, path: str = "") -> object:
    """value as the schema has it, fields that it doesn't have left out and missing ones null; raises ValueError, with the path, where a type differs."""
    if value is None:
        return None
    if isinstance(kind, T.StructType) and isinstance(value, dict):
        return {f.name: fitted(value.get(f.name), f.dataType, f"{path}.{f.name}" if path else f.name) for f in kind}
    if isinstance(kind, T.ArrayType) and isinstance(value, list):
        return [fitted(x, kind.elementType, f"{path}[{i}]") for i, x in enumerate(value)]
    if isinstance(kind, T.MapType) and isinstance(value, dict):
        return [(_utf8(k), fitted(x, kind.valueType, f"{path}.{k}")) for k, x in value.items()]
    if isinstance(kind, T.StringType) and isinstance(value, str):
        return _utf8(value)
    if isinstance(kind, T.BooleanType) and isinstance(value, bool):
        return value
    if isinstance(kind, T.IntegerType) and type(value) is int and abs(value) < 1 << 31:
        return value
    raise ValueError(f"{_utf8(path)} is not {kind.typeName()}")


def _utf8(text: str) -> str:
    return text if text.isascii() else text.encode("utf-8", "replace").decode()


def scanned(line: str | None, schema: T.StructType = RECORD) -> dict:
    """SCAN of one line. A record has a list of messages that aren't null."""
    if line is None or not line.strip():
        return {"reason": "blank"}
    try:
        value = json.loads(line)
    except (ValueError, RecursionError):
        return {"reason": "not JSON"}
    if not isinstance(value, dict):
        return {"reason": "not an object"}
    try:
        record = fitted(value, schema)
    except ValueError as e:
        return {"reason": str(e)}
    if not isinstance(record.get("messages"), list):
        return {"reason": "no messages"}
    if any(m is None for m in record["messages"]):
        return {"reason": "a message is null"}
    return {"record": record}


@F.arrow_udf(SCAN)
def _scan(lines: pa.Array) -> pa.Array:
    """Only one slice's records are Python objects at a time: a record's are many times as large as its line."""
    kind = to_arrow_type(SCAN)
    return pa.concat_arrays([pa.array([], kind), *(pa.array([scanned(x) for x in part.to_pylist()], kind) for part in slices(lines))])


def scan(spark: SparkSession, path: str) -> DataFrame:
    """file, line, reason and the record's columns, a row for each line of the files at path, blank lines and rejected ones too; lines end with \\n or \\r\\n.

    An empty folder of files gives an empty result. Lines are read in splits, so a large file is many tasks' work.
    """
    return scanned_lines(spark.read.option("lineSep", "\n").text(path))


def scanned_lines(lines: DataFrame) -> DataFrame:
    """scan() of lines that Spark's text source reads, as a table or as a stream."""
    bounded_batches(lines.sparkSession)
    rows = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")).withColumn("x", _scan("line"))
    return rows.select("file", "line", "x.reason", "x.record.*")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The good lines' records."""
    return scan(spark, path).where("reason IS NULL").select(*RECORD.names)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """file, line, reason of the lines that are neither records nor blank."""
    return scan(spark, path).where("reason <> 'blank'").select("file", "line", "reason")


def load(spark: SparkSession, path: str, rejects: str) -> DataFrame:
    """The good records, after one pass over the files at path that also writes the rejected lines, with file and reason, as JSON Lines to rejects (earlier contents are replaced)."""
    out = scratch_dir(spark, "scan")
    found = scan(spark, path).withColumn("good", F.col("reason").isNull())
    found.where("reason IS NULL OR reason <> 'blank'").write.partitionBy("good").parquet(out)
    kept = spark.read.schema(T.StructType([*found.schema])).parquet(out)
    kept.where("NOT good").select("file", "line", "reason").write.mode("overwrite").json(rejects)
    return kept.where("good").select(*RECORD.names)
