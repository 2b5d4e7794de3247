"""Distribution reports: counts by several keys in one pass, shares, and their text forms."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.functions.rounding import one_decimal


def distribution(rows: DataFrame, keys: list[str], by: str = "dataset", order: str = "id") -> DataFrame:
    """by, dimension, value, n, first_seen, pct: counts of each key's values in each dataset, by grouping sets.

    A missing value counts as `?`; first_seen, the least order value, breaks ties as a stable sort would.
    """
    rows = rows.select(by, order, *[F.coalesce(F.col(k).cast("string"), F.lit("?")).alias(k) for k in keys])
    dimension = None
    for k in keys:
        dimension = F.when(F.grouping(k) == 0, k) if dimension is None else dimension.when(F.grouping(k) == 0, k)
    sets = rows.groupingSets([[F.col(by), F.col(k)] for k in keys], F.col(by), *[F.col(k) for k in keys])
    counted = sets.agg(dimension.alias("dimension"), F.coalesce(*keys).alias("value"), F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen")).select(by, "dimension", "value", "n", "first_seen")
    return counted.withColumn("pct", F.col("n") * F.lit(100.0) / F.sum("n").over(Window.partitionBy(by, "dimension")))


def top(counts: DataFrame, k: int, by: str = "dataset") -> DataFrame:
    """The k most frequent values of each dataset and dimension, with their rank."""
    rank = F.row_number().over(Window.partitionBy(by, "dimension").orderBy(F.desc("n"), "first_seen"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


def markdown(counts: DataFrame, title: str = "Dataset report", paths: dict[str, str] | None = None) -> str:
    """A report of a few rows a dataset (counts as from distribution()): total, languages by count, five top tools, difficulties by name."""
    rows = sorted(counts.collect(), key=lambda r: (r["dataset"], -r["n"], r["first_seen"]))
    names = list(dict.fromkeys(r["dataset"] for r in rows))
    out = [f"# {title}", "", f"Generated: {datetime.now().isoformat()}", "", f"Total datasets: {len(names)}", ""]
    for name in names:
        own = [r for r in rows if r["dataset"] == name]
        total = sum(r["n"] for r in own if r["dimension"] == own[0]["dimension"])
        out += [f"### {name}", f"- Total: {total}", *([f"- File: `{paths[name]}`"] if paths else []), ""]
        for heading, dimension, most, key in (("Languages", "language", None, None), ("Top Tools", "tool_name", 5, None), ("Difficulty", "difficulty", None, "value")):
            part = [r for r in own if r["dimension"] == dimension]
            part = sorted(part, key=lambda r: r[key]) if key else part
            out += [f"**{heading}:**", *[f"  - {r['value']}: {r['n']} ({r['pct']:.1f}%)" for r in part[:most]], ""]
    return "\n".join(out)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A folder with the text as one file, wherever Spark can write."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def console(counts: DataFrame) -> DataFrame:
    """dataset, dimension, place, line, in order: tools by count with a bar of half a mark a percent, difficulties by name, the eight most frequent languages."""
    by_count = F.row_number().over(Window.partitionBy("dataset", "dimension").orderBy(F.desc("n"), "first_seen"))
    by_name = F.row_number().over(Window.partitionBy("dataset", "dimension").orderBy("value"))
    place = F.when(F.col("dimension") == "difficulty", by_name).otherwise(by_count)
    wide = F.when(F.col("dimension") == "tool_name", 15).when(F.col("dimension") == "difficulty", 10).otherwise(5)
    bar = F.when(F.col("dimension") == "tool_name", F.concat(F.lit(" "), F.repeat(F.lit("█"), F.floor(F.col("pct") / 2).cast("int")))).otherwise("")
    padded = F.concat("value", F.repeat(F.lit(" "), F.greatest(F.lit(0), wide - F.length("value"))))
    line = F.concat(padded, F.lit(": "), F.format_string("%6d (", "n"), F.lpad(one_decimal(F.col("pct")), 5, " "), F.lit("%)"), bar)
    rows = counts.select("dataset", "dimension", place.alias("place"), line.alias("line"))
    return rows.where("dimension <> 'language' OR place <= 8").orderBy("dataset", F.desc("dimension"), "place")
