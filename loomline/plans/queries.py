"""Registered queries of the trajectory engine and, for each that SQL can express, DuckDB SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.functions import draws
from loomline.operators import render, report, split, validate
from loomline.operators.sampler import FRESH, with_intents
from loomline.plans import generate
from loomline.sources import dimensions

#: What the draws are for: the ids of a table, a trajectory each.
ROWS = "(SELECT event_id AS id FROM events) r"
SEED = generate.SEED
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_ids(spark: SparkSession, sf_dir: str, table: str = "events", column: str = "event_id") -> DataFrame:
    """The ids of events, or of another table, dealt out over tasks, as what is made of an id is far more work than reading it."""
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return _t(spark, sf_dir, table).select(F.col(column).alias("id")).repartition(tasks, "id")


def _u(stream: str, seed: int | str = SEED, row: str = "id") -> str:
    """SQL for draws.uniform."""
    return f"(('0x' || substr(md5('{seed}|{stream}|' || {row}), 1, 8))::BIGINT / 4294967296::DOUBLE)" if isinstance(seed, int) else f"(('0x' || substr(md5({seed} || '|{stream}|' || {row}), 1, 8))::BIGINT / 4294967296::DOUBLE)"


def _ladder(u: str, steps: list[tuple[str, float]]) -> str:
    total, at, out = sum(w for _, w in steps), 0.0, "CASE"
    for value, weight in steps[:-1]:
        at += weight
        out += f" WHEN {u} < {at / total!r}::DOUBLE THEN '{value}'"
    return f"{out} ELSE '{steps[-1][0]}' END"


def _tool_sql(seed: int | str = SEED) -> str:
    return _ladder(_u("tool", seed), [(t[0], t[2]) for t in dimensions.TOOLS])


_TOOL = _tool_sql()
_LOCALE_ROWS = ", ".join(f"({i}, '{a}', '{b}', '{c}')" for i, (a, b, c) in enumerate(dimensions.LOCALES))


def intent_rows(repair: bool = False) -> str:
    quoted = lambda x: x.replace("'", "''")
    return ", ".join(f"('{dimensions.REPAIRED.get(t, t) if repair else t}', {i}, '{quoted(q)}', '{quoted(a)}')" for t, i, q, a in dimensions.INTENTS)


def diverse_sql(rows: str) -> str:
    """CTEs that end with diverse: id, tool_name, query, arguments of the diversity sampler's picks."""
    return f"""i(tool_name, idx, query, arguments) AS (VALUES {rows}),
p AS (SELECT *, row_number() OVER (PARTITION BY tool_name ORDER BY md5('{SEED}|perm|' || tool_name || '|' || idx), idx) AS k, count(*) OVER (PARTITION BY tool_name) AS n FROM i),
d AS (SELECT id, {_TOOL} AS tool_name FROM {ROWS}),
f AS (SELECT d.*, (SELECT max(n) FROM p WHERE p.tool_name = d.tool_name) AS n, {_u('fresh')} < {FRESH}::DOUBLE AS fresh FROM d),
g AS (SELECT *, sum((fresh AND n IS NOT NULL)::INT) OVER (PARTITION BY tool_name ORDER BY id) AS c FROM f),
h AS (SELECT g.*, CASE WHEN fresh AND c <= n THEN c END AS k FROM g),
diverse AS (SELECT h.id, h.tool_name, coalesce(a.query, b.query, 'use ' || h.tool_name) AS query, coalesce(a.arguments, b.arguments, '{{}}') AS arguments FROM h
LEFT JOIN p a ON a.tool_name = h.tool_name AND a.k = h.k
LEFT JOIN i b ON b.tool_name = h.tool_name AND b.idx = floor({_u('intent', row='h.id')} * h.n)::INT)"""


@query("""SELECT conv_id, min_by(role, turn) AS first_role, max_by(role, turn) AS last_role,
 min_by(role, turn) = 'system' AS starts_with_system, max_by(role, turn) = 'assistant' AS ends_with_assistant FROM conversations GROUP BY conv_id""")
def conv_first_last_roles(spark, sf_dir):
    first, last = F.min_by("role", "turn"), F.max_by("role", "turn")
    return _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(first.alias("first_role"), last.alias("last_role"), (first == "system").alias("starts_with_system"), (last == "assistant").alias("ends_with_assistant"))


@query("SELECT conv_id, count(*) AS n_messages, count(*) < 4 AS too_few FROM conversations GROUP BY conv_id")
def conv_message_count_check(spark, sf_dir):
    return _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_messages")).withColumn("too_few", F.col("n_messages") < 4)


@query("""WITH x AS (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations WHERE role <> 'system')
SELECT conv_id, count(*) AS n_turns, count(*) FILTER (role = before) AS n_repeats FROM x GROUP BY conv_id""")
def conv_role_alternation(spark, sf_dir):
    before = F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn"))
    rows = _t(spark, sf_dir, "conversations").where("role <> 'system'").withColumn("before", before)
    return rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), F.count_if(F.col("role") == F.col("before")).alias("n_repeats"))


@query("""SELECT conv_id, count(*) AS n_assistant, count(*) FILTER (NOT coalesce(json_valid(text), false)) AS n_not_json FROM conversations WHERE role = 'assistant' GROUP BY conv_id""")
def conv_assistant_json_check(spark, sf_dir):
    rows = _t(spark, sf_dir, "conversations").where("role = 'assistant'").withColumn("json", validate.strict_json("text"))
    return rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_assistant"), F.count_if(F.col("json").isNull()).alias("n_not_json"))


@query("""WITH c AS (SELECT conv_id, count(*) AS n, min_by(role, turn) AS f, max_by(role, turn) AS l FROM conversations GROUP BY conv_id),
i AS (SELECT 'few_messages' AS code FROM c WHERE n < 4 UNION ALL SELECT 'first_not_system' FROM c WHERE f IS DISTINCT FROM 'system' UNION ALL SELECT 'BAD_LAST_ROLE' FROM c WHERE l IS DISTINCT FROM 'assistant')
SELECT code, count(*) AS n FROM i GROUP BY code""")
def conv_issue_counts(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min_by("role", "turn").alias("f"), F.max_by("role", "turn").alias("l"))
    codes = F.array(F.when(F.col("n") < 4, "few_messages"), F.when(~F.coalesce(F.col("f") == "system", F.lit(False)), "first_not_system"), F.when(~F.coalesce(F.col("l") == "assistant", F.lit(False)), "BAD_LAST_ROLE"))
    return c.select(F.explode(codes).alias("code")).where("code IS NOT NULL").groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH c AS (SELECT count(*) >= 4 AND max_by(role, turn) = 'assistant' AS ok FROM conversations GROUP BY conv_id)
SELECT count(*) AS total, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid FROM c""")
def conv_batch_stats(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(((F.count(F.lit(1)) >= 4) & (F.max_by("role", "turn") == "assistant")).alias("ok"))
    return c.agg(F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("valid"), F.count_if(~F.col("ok")).alias("invalid"))


@query(r"""SELECT conv_id, sum(octet_length(encode(text)))::BIGINT AS n_bytes, sum(CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) - (ends_with(text, chr(10)))::INT END)::BIGINT AS n_lines FROM conversations GROUP BY conv_id""")
def conv_byte_and_line_counts(spark, sf_dir):
    return _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sum(F.octet_length("text").cast("long")).alias("n_bytes"), F.sum(render.lines(F.col("text")).cast("long")).alias("n_lines"))


def _shares(rows: DataFrame, key: str) -> DataFrame:
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 6))


@query("SELECT role, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct FROM conversations GROUP BY role")
def role_distribution_pct(spark, sf_dir):
    return _shares(_t(spark, sf_dir, "conversations"), "role")


@query("SELECT event_type, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct FROM events GROUP BY event_type")
def event_type_pct(spark, sf_dir):
    return _shares(_t(spark, sf_dir, "events"), "event_type")


@query("SELECT lang, count(*) AS n, min(doc_id) AS first_seen FROM documents GROUP BY lang ORDER BY n DESC, first_seen LIMIT 8")
def lang_distribution_topk(spark, sf_dir):
    return _t(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_seen")).orderBy(F.desc("n"), "first_seen").limit(8)


@query("""WITH c AS (SELECT lang, source, count(*) AS n, min(doc_id) AS f FROM documents GROUP BY lang, source)
SELECT lang, source, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, f) AS rank FROM c QUALIFY rank <= 5""")
def source_topk_per_lang(spark, sf_dir):
    c = _t(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("f"))
    return c.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "f"))).where("rank <= 5").drop("f")


@query("""WITH x AS (SELECT source AS dataset, doc_id AS id, lang, coalesce(quality::VARCHAR, '?') AS quality FROM documents LEFT JOIN labels USING (doc_id))
SELECT dataset, CASE WHEN grouping(lang) = 0 THEN 'lang' ELSE 'quality' END AS dimension, coalesce(lang, quality) AS value, count(*) AS n, min(id) AS first_seen,
round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY dataset, grouping(lang)), 6) AS pct FROM x GROUP BY GROUPING SETS ((dataset, lang), (dataset, quality))""")
def report_grouping_sets(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left").select(F.col("source").alias("dataset"), F.col("doc_id").alias("id"), "lang", "quality")
    return report.distribution(rows, ["lang", "quality"]).withColumn("pct", F.round("pct", 6))


@query("""WITH t AS (SELECT doc_id, CASE WHEN lang = 'it' AND source = 'src1' THEN 0 WHEN lang IN ('it', 'es') THEN 1 ELSE 2 END AS tier FROM documents)
SELECT doc_id, tier FROM t WHERE tier <= (SELECT min(tier) FROM t)""")
def lang_filter_with_fallback(spark, sf_dir):
    tier = F.when((F.col("lang") == "it") & (F.col("source") == "src1"), 0).when(F.col("lang").isin("it", "es"), 1).otherwise(2)
    rows = _t(spark, sf_dir, "documents").select("doc_id", tier.alias("tier"))
    return rows.join(F.broadcast(rows.agg(F.min("tier").alias("least"))), F.col("tier") <= F.col("least")).drop("least")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def label_semi_join(spark, sf_dir):
    return _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left_semi").select("doc_id", "lang")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def label_anti_join(spark, sf_dir):
    return _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id", "lang")


_POS = "row_number() OVER (ORDER BY md5('7|' || doc_id), doc_id) - 1"


@query(f"""WITH p AS (SELECT doc_id, {_POS} AS pos, count(*) OVER () AS c FROM documents)
SELECT doc_id, pos, CASE WHEN pos < floor(c * 0.70::DOUBLE)::BIGINT THEN 'train' WHEN pos < floor(c * 0.70::DOUBLE)::BIGINT + floor(c * 0.15::DOUBLE)::BIGINT THEN 'eval' ELSE 'test' END AS split FROM p""")
def split_70_15_15(spark, sf_dir):
    return split.split_70_15_15(_t(spark, sf_dir, "documents").select("doc_id"), "doc_id", 7)


@query("""WITH c AS (SELECT count(*) AS c FROM documents), s AS (SELECT floor(c * 0.70::DOUBLE)::BIGINT AS a, floor(c * 0.15::DOUBLE)::BIGINT AS b, c FROM c)
SELECT 'train' AS split, a AS n FROM s UNION ALL SELECT 'eval', b FROM s UNION ALL SELECT 'test', c - a - b FROM s""")
def split_sizes(spark, sf_dir):
    return split_70_15_15(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT conv_id, turn, role FROM conversations ORDER BY md5('5|' || conv_id || '|' || turn), conv_id, turn LIMIT 20")
def replay_sample(spark, sf_dir):
    key = F.md5(F.concat_ws("|", F.lit("5"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).cast("binary"))
    return _t(spark, sf_dir, "conversations").orderBy(key, "conv_id", "turn").limit(20).select("conv_id", "turn", "role")


@query("SELECT event_type, count(*) AS n, count(*) FILTER (list_contains(json_keys(props), 'k')) AS with_k, count(DISTINCT json_extract_string(props, '$.k')) AS n_values FROM events GROUP BY event_type")
def event_props_json_keys(spark, sf_dir):
    has = F.array_contains(F.json_object_keys("props"), "k")
    return _t(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(has).alias("with_k"), F.countDistinct(F.get_json_object("props", "$.k")).alias("n_values"))


@query(f"SELECT {_TOOL} AS tool_name, count(*) AS n, min(id) AS first_seen, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events), 6) AS pct FROM {ROWS} GROUP BY 1")
def gen_tool_distribution(spark, sf_dir):
    rows = row_ids(spark, sf_dir).select("id", draws.tool(SEED, F.col("id")).alias("tool_name"))
    counts = rows.groupBy("tool_name").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_seen"))
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 6))


@query(f"SELECT {_ladder(_u('difficulty'), dimensions.DIFFICULTIES)} AS difficulty, count(*) AS n FROM {ROWS} GROUP BY 1")
def gen_difficulty(spark, sf_dir):
    return row_ids(spark, sf_dir).groupBy(draws.difficulty(SEED, F.col("id")).alias("difficulty")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH l(pos, language, tone, formality) AS (VALUES {_LOCALE_ROWS}) SELECT language, tone, formality, count(*) AS n FROM {ROWS} JOIN l ON l.pos = floor({_u('locale')} * {len(dimensions.LOCALES)})::INT GROUP BY ALL")
def gen_locale(spark, sf_dir):
    return generate.bulk_draws(spark, row_ids(spark, sf_dir)).groupBy("language", "tone", "formality").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT {_TOOL} AS tool_name, count(*) AS n, count(*) FILTER ({_u('failure')} > 0.15::DOUBLE) AS n_success FROM {ROWS} GROUP BY 1")
def gen_success_rate(spark, sf_dir):
    return generate.bulk_draws(spark, row_ids(spark, sf_dir)).groupBy("tool_name").agg(F.count(F.lit(1)).alias("n"), F.count_if("success").alias("n_success"))


@query(f"WITH {diverse_sql(intent_rows())} SELECT id, tool_name, query FROM diverse")
def gen_intent_diversity(spark, sf_dir):
    ids, above = generate.ids_of(spark, row_ids(spark, sf_dir))
    return with_intents(spark, generate.bulk_draws(spark, ids), above, prefix=1024).select("id", "tool_name", "query")


@query("SELECT l AS language, t AS tone, f AS formality, count(*) AS n FROM (VALUES ('en'), ('hi'), ('es')) a(l), (VALUES ('casual'), ('technical')) b(t), (VALUES ('formal'), ('neutral')) c(f), supplier GROUP BY ALL")
def gen_locale_cross_product(spark, sf_dir):
    made = generate.localized_batch(spark, ["en", "hi", "es"], ["casual", "technical"], ["formal", "neutral"], row_ids(spark, sf_dir, "supplier", "s_suppkey"))
    return made.groupBy(*[F.col(f"localization.{c}").alias(c) for c in ("language", "tone", "formality")]).agg(F.count(F.lit(1)).alias("n"))


_CONFIG_ROWS = ", ".join(f"('{n}', {langs!r}, {tones!r}, {list(forms)!r})" for n, _, _, langs, tones, forms in dimensions.CONFIGS)


@query(f"""WITH l(pos, language, tone, formality) AS (VALUES {_LOCALE_ROWS}), c(dataset, ls, ts, fs) AS (VALUES {_CONFIG_ROWS})
SELECT dataset, language, tone, formality, (SELECT count(*) FROM documents WHERE lang = language) AS n_documents FROM c, l WHERE list_contains(ls, language) AND list_contains(ts, tone) AND list_contains(fs, formality)""")
def gen_config_locale_matches(spark, sf_dir):
    """Each config's locales, with the number of documents in their language."""
    n = _t(spark, sf_dir, "documents").groupBy(F.col("lang").alias("language")).agg(F.count(F.lit(1)).alias("n_documents"))
    fits = generate.config_locales(spark).select("dataset", F.inline("locales")).select("dataset", "language", "tone", "formality")
    return fits.join(n, "language", "left").select("dataset", "language", "tone", "formality", F.coalesce("n_documents", F.lit(0)).alias("n_documents"))


def rules_sql(command: str = "command") -> str:
    clause = lambda words: " AND ".join(f"contains({command}, '{w}')" for w in words)
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'({clause(w)})' for w in clauses)} THEN '{name}'" for name, clauses in dimensions.BASH_RULES) + " ELSE 'other' END"


_COMMAND_OF = "(WITH c(k, command) AS (VALUES " + ", ".join("({}, '{}')".format(i, c.replace("'", "''")) for i, c in enumerate(dimensions._COMMANDS)) + f") SELECT doc_id, command || ' ' || text AS command FROM documents JOIN c ON k = doc_id % {len(dimensions._COMMANDS)})"


@query(f"SELECT doc_id, {rules_sql()} AS rule, length(command) AS n_chars FROM {_COMMAND_OF}")
def gen_bash_dispatch(spark, sf_dir):
    """The rule that each document's command meets: one of the Bash intents', and the document's text after it."""
    commands = dimensions.intents(spark).where("tool_name = 'Bash'").select(F.col("idx").alias("k"), F.get_json_object("arguments", "$.command").alias("command"))
    rows = _t(spark, sf_dir, "documents").withColumn("k", (F.col("doc_id") % len(dimensions._COMMANDS)).cast("int")).join(F.broadcast(commands), "k")
    rows = rows.select("doc_id", F.concat("command", F.lit(" "), "text").alias("command"))
    return rows.select("doc_id", render.bash_rule(F.col("command")).alias("rule"), F.length("command").cast("long").alias("n_chars"))


_CONFIG_SEEDS = ", ".join(f"('{n}', {s}, {i})" for i, (n, s, *_) in enumerate(dimensions.CONFIGS))


@query(f"""WITH c(dataset, seed, k) AS (VALUES {_CONFIG_SEEDS}), cl(dataset, ls, ts, fs) AS (VALUES {_CONFIG_ROWS}), l(pos, language, tone, formality) AS (VALUES {_LOCALE_ROWS}),
fit AS (SELECT dataset, language, row_number() OVER (PARTITION BY dataset ORDER BY pos) - 1 AS k, count(*) OVER (PARTITION BY dataset) AS n_fit FROM cl, l WHERE list_contains(ls, language) AND list_contains(ts, tone) AND list_contains(fs, formality)),
d AS (SELECT dataset, seed, event_id // {len(dimensions.CONFIGS)} AS id FROM events JOIN c ON k = event_id % {len(dimensions.CONFIGS)}),
x AS (SELECT d.dataset, id, language, {_tool_sql('seed')} AS tool_name, {_ladder(_u('difficulty', 'seed'), dimensions.DIFFICULTIES)} AS difficulty FROM d JOIN fit ON fit.dataset = d.dataset AND fit.k = floor({_u('locale', 'seed')} * n_fit)::INT)
SELECT dataset, CASE WHEN grouping(tool_name) = 0 THEN 'tool_name' WHEN grouping(difficulty) = 0 THEN 'difficulty' ELSE 'language' END AS dimension, coalesce(tool_name, difficulty, language) AS value, count(*) AS n, min(id) AS first_seen,
 round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY dataset, grouping(tool_name), grouping(difficulty)), 6) AS pct
FROM x GROUP BY GROUPING SETS ((dataset, tool_name), (dataset, difficulty), (dataset, language))""")
def gen_report_by_dataset(spark, sf_dir):
    return report.distribution(generate.config_draws(spark, row_ids(spark, sf_dir)), ["tool_name", "difficulty", "language"]).withColumn("pct", F.round("pct", 6))
