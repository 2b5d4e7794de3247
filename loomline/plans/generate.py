"""The three ways to make trajectories: in bulk, by dataset configs, and through the library calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions import draws
from loomline.operators import report
from loomline.operators.render import trajectories
from loomline.operators.sampler import with_intents, with_library_intents
from loomline.operators.split import split_70_15_15
from loomline.operators.validate import valid_only
from loomline.sources import dimensions, jsonl

SEED = 2026


def ids_of(spark: SparkSession, rows: int | DataFrame) -> tuple[DataFrame, int]:
    """id, and a number above all ids: of a table's own column id, from 0 on, or of so many rows."""
    if isinstance(rows, int):
        return spark.range(rows), rows
    last = rows.agg(F.max("id")).first()[0]
    return rows.select(F.col("id").cast("long").alias("id")), 0 if last is None else last + 1


def bulk_draws(spark: SparkSession, count: int | DataFrame, seed: int = SEED, error_rate: float = 0.15, honor_error_rate: bool = False) -> DataFrame:
    """A row of draws for each id (see ids_of): tool, difficulty, locale, success. The rate only switches errors on, at 0.15, unless honored."""
    rows = ids_of(spark, count)[0].select(F.lit("bulk").alias("dataset"), F.lit(seed).cast("long").alias("seed"), "id")
    at = F.get(F.array(*[F.struct(F.lit(a).alias("language"), F.lit(b).alias("tone"), F.lit(c).alias("formality")) for a, b, c in dimensions.LOCALES]), draws.pick(draws.uniform("locale", seed, F.col("id")), len(dimensions.LOCALES)))
    return rows.select("*", draws.tool(seed, F.col("id")).alias("tool_name"), draws.difficulty(seed, F.col("id")).alias("difficulty"), at.alias("l"), draws.success(seed, F.col("id"), error_rate > 0, error_rate if honor_error_rate else 0.15).alias("success")).select("*", "l.*").drop("l")


def bulk(spark: SparkSession, count: int | DataFrame = 100_000, seed: int = SEED, error_rate: float = 0.15, repair: bool = False, generated_at: str | None = None) -> DataFrame:
    """count trajectories, without any that the validator rejects (all drawn rows render to valid ones)."""
    return valid_only(bulk_unchecked(spark, count, seed, error_rate, repair, generated_at))


def bulk_unchecked(spark: SparkSession, count: int | DataFrame = 100_000, seed: int = SEED, error_rate: float = 0.15, repair: bool = False, generated_at: str | None = None) -> DataFrame:
    """count trajectories as they are drawn."""
    return trajectories(spark, with_intents(spark, bulk_draws(spark, count, seed, error_rate), ids_of(spark, count)[1], repair=repair), generated_at)


def bulk_to_jsonl(spark: SparkSession, path: str, count: int = 100_000, seed: int = SEED, error_rate: float = 0.15) -> None:
    """Shuffle, split 70/15/15 and write a folder for each split."""
    jsonl.write(split_70_15_15(bulk(spark, count, seed, error_rate), "id", seed), path, ["split"])


def config_locales(spark: SparkSession) -> DataFrame:
    """dataset, seed, rows, locales: each config's locales in order, by language, tone and formality; if none fit by language; else all."""
    met = dimensions.configs(spark).crossJoin(F.broadcast(dimensions.locales(spark)))
    lang = F.array_contains("languages", F.col("language"))
    tier = F.when(lang & F.array_contains("tones", F.col("tone")) & F.array_contains("formalities", F.col("formality")), 0).when(lang, 1).otherwise(2)
    grouped = met.withColumn("tier", tier).groupBy("dataset", "seed", "rows").agg(F.min("tier").alias("best"), F.sort_array(F.collect_list(F.struct("pos", "language", "tone", "formality", "tier"))).alias("l"))
    fits = F.when(F.col("best") == 0, F.filter("l", lambda x: x["tier"] == 0)).when(F.col("best") == 1, F.filter("l", lambda x: x["tier"] <= 1)).otherwise(F.col("l"))
    return grouped.select("dataset", "seed", "rows", fits.alias("locales"))


def config_draws(spark: SparkSession, ids: DataFrame | None = None) -> DataFrame:
    """Draws of all datasets in one DataFrame; errors are off. Each dataset has as many rows as its config says, or, of a table's ids, every tenth (by as many as there are configs)."""
    configs = config_locales(spark)
    if ids is None:
        rows = configs.select("*", F.explode(F.expr("sequence(0L, rows - 1)")).alias("id"))
    else:
        k = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(dimensions.CONFIGS) for x in (i, c[0])]), F.pmod(F.col("id"), F.lit(len(dimensions.CONFIGS))).cast("int"))
        rows = ids.select(k.alias("dataset"), F.floor(F.col("id") / len(dimensions.CONFIGS)).alias("id")).join(F.broadcast(configs), "dataset")
    at = F.get("locales", draws.pick(draws.uniform("locale", F.col("seed"), F.col("id")), F.size("locales")))
    return rows.select("dataset", "seed", "id", draws.tool(F.col("seed"), F.col("id")).alias("tool_name"), draws.difficulty(F.col("seed"), F.col("id")).alias("difficulty"), at["language"].alias("language"), at["tone"].alias("tone"), at["formality"].alias("formality"), F.lit(True).alias("success"))


def config_datasets(spark: SparkSession, generated_at: str | None = None) -> DataFrame:
    """The ten review datasets, valid rows only."""
    return valid_only(trajectories(spark, with_intents(spark, config_draws(spark), 1000), generated_at))


def config_datasets_to_jsonl(spark: SparkSession, path: str) -> None:
    """A folder of JSON Lines for each review dataset, and REPORT.md beside them."""
    jsonl.write(config_datasets(spark), f"{path}/datasets", ["dataset"])
    counts = report.distribution(config_draws(spark), ["language", "tool_name", "difficulty"])
    report.write_text(spark, report.markdown(counts, "Dataset Generation Report", {c[0]: f"{path}/datasets/dataset={c[0]}" for c in dimensions.CONFIGS}), f"{path}/REPORT.md")


def library_batch(spark: SparkSession, count: int | DataFrame, seed: int = SEED, include_error: bool = False, generated_at: str | None = None) -> DataFrame:
    """The library entry: each axis of the locale is drawn by itself, and intents are any of the library's own."""
    row = F.col("id")
    axis = lambda name, values: F.get(F.array(*[F.lit(v) for v in values]), draws.pick(draws.uniform(name, seed, row), len(values)))
    drawn = ids_of(spark, count)[0].select(F.lit("library").alias("dataset"), F.lit(seed).cast("long").alias("seed"), "id", draws.tool(seed, row).alias("tool_name"), draws.difficulty(seed, row).alias("difficulty"), axis("language", dimensions.LIBRARY_LANGUAGES).alias("language"), axis("tone", dimensions.TONES).alias("tone"), axis("formality", dimensions.FORMALITIES).alias("formality"), draws.success(seed, row, include_error).alias("success"))
    return valid_only(trajectories(spark, with_library_intents(spark, drawn), generated_at))


def localized_batch(spark: SparkSession, languages: list[str], tones: list[str], formalities: list[str], count: int | DataFrame, seed: int = SEED, rerender: bool = False) -> DataFrame:
    """count rows (or a table's ids) for each combination. The label is set after rendering, as the prompt keeps the drawn locale, unless rerender."""
    n = len(languages) * len(tones) * len(formalities)
    each = ids_of(spark, count)[0].select("id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k"))
    ids = each.select((F.col("id") * n + F.col("k")).alias("id"))
    made = library_batch(spark, ids, seed)
    at = lambda values, step: F.get(F.array(*[F.lit(v) for v in values]), (F.floor(F.col("id") / step) % len(values)).cast("int"))
    lang, tone, formality = at(languages, len(tones) * len(formalities)), at(tones, len(formalities)), at(formalities, 1)
    place = F.struct(lang.alias("language"), tone.alias("tone"), formality.alias("formality"), F.lit(True).alias("humanize"), F.lit("medium").alias("humanize_level"))
    out = made.withColumn("localization", place)
    if rerender:
        first = F.get("messages", F.lit(0))
        prompt = F.regexp_replace(first["content"], "Language: [^,]*, tone: [^,]*, formality: [^.]*", F.concat(F.lit("Language: "), lang, F.lit(", tone: "), tone, F.lit(", formality: "), formality))
        out = out.withColumn("messages", F.concat(F.array(first.withField("content", prompt)), F.slice("messages", 2, 4)))
    return out
