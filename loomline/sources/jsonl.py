"""JSON Lines sources and sinks for trajectories, with an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.tables import scratch_dir  # noqa: F401  part of this module's names
from loomline.operators.render import MESSAGE, function_schemas
from loomline.sources import dimensions

_S = T.StringType()
LOCALE = T.StructType([T.StructField(n, T.BooleanType() if n == "humanize" else _S) for n in ("language", "tone", "formality", "humanize", "humanize_level")])
_PROPERTY = T.StructType([T.StructField("type", _S), T.StructField("description", _S), T.StructField("enum", T.ArrayType(_S))])
_PARAMETERS = T.StructType([T.StructField("type", _S), T.StructField("properties", T.MapType(_S, _PROPERTY)), T.StructField("required", T.ArrayType(_S))])
_FUNCTION = T.StructType([T.StructField("name", _S), T.StructField("description", _S), T.StructField("parameters", _PARAMETERS)])
TOOLS = T.ArrayType(T.StructType([T.StructField("type", _S), T.StructField("function", _FUNCTION)]))
METADATA = T.StructType([T.StructField("difficulty", _S), T.StructField("tool_category", _S), T.StructField("tool_name", _S), T.StructField("tools_used", T.ArrayType(_S)), T.StructField("num_tools", T.IntegerType()), T.StructField("success", T.BooleanType()), T.StructField("generated_at", _S), T.StructField("generator_version", _S)])
RECORD = T.StructType([T.StructField("messages", MESSAGE), T.StructField("localization", LOCALE), T.StructField("tools", TOOLS), T.StructField("metadata", METADATA)])


def wire_tools(spark: SparkSession) -> Column:
    """The registry's function schemas as a literal; the same for every row."""
    rows = sorted(function_schemas(dimensions.tools(spark)).select("pos", F.to_json("schema").alias("schema")).collect())
    return F.from_json(F.lit(f"[{','.join(r['schema'] for r in rows)}]"), TOOLS)


def records(trajectories: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The wire form: empty optional fields become null, which the writer leaves out; tools is one literal for all rows. keep: more columns."""
    empty_to_null = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), F.nullif(m["tool_call_id"], F.lit("")).alias("tool_call_id"), F.nullif(m["name"], F.lit("")).alias("name")))
    tools = wire_tools(trajectories.sparkSession)
    return trajectories.select(empty_to_null.alias("messages"), "localization", tools.alias("tools"), "metadata", *(keep or []))


def write(trajectories: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A folder of JSON Lines files, one folder below it for each value of partition_by; earlier contents are replaced."""
    writer = records(trajectories, partition_by).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records as write() has written them; a line that is none fails the read. Files from elsewhere are for sources.records to read."""
    return spark.read.schema(RECORD).option("mode", "FAILFAST").json(path)


def write_bad_rows(issues: DataFrame, path: str) -> None:
    """CSV of id and issues for rows that have any."""
    issues.where(F.size("issues") > 0).select("id", F.array_join("issues", "; ").alias("issues")).write.mode("overwrite").option("header", True).csv(path)


def write_review_comments(codes: DataFrame, path: str) -> None:
    """JSON Lines of id, turn, code, category and a comment, a line for each code that the critic gives."""
    comment = F.concat(F.col("category"), F.lit(": "), F.lower(F.regexp_replace("code", "_", " ")))
    codes.withColumn("comment", comment).write.mode("overwrite").json(path)


def training_messages(messages: Column) -> Column:
    """The (role, content) structs of messages, which trainers read."""
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))


def training_form(records: DataFrame) -> DataFrame:
    """Records as (role, content) messages and the tools' JSON: the projection that trainers read."""
    return records.select(training_messages(F.col("messages")).alias("messages"), F.to_json("tools").alias("tools"))
