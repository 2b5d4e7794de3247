"""Queries of sources, sinks, reports, streams and draws over the given tables, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomline.functions.tables import scratch_dir, written
from loomline.operators import increments, picks, repair, split
from loomline.operators.sampler import FRESH
from loomline.plans.queries import SQL, _t, _u, query
from loomline.plans.record_queries import _as_records
from loomline.plans.review_queries import payload_records, payload_turns
from loomline.sources import jsonl, records
from loomline.streaming import counts

#: Ids of a batch, as the bulk run counts them.
BATCH = 5000

#: What happens to a line by the first hex digit of a hash of it; all other digits leave it alone.
_DAMAGE = {"0": "broken", "1": "list", "2": "type", "3": "blank", "4": "no messages", "5": "tail"}


@query("""WITH c AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id), h AS (SELECT *, substr(md5('line|' || conv_id || '|' || n), 1, 1) AS d FROM c)
SELECT CASE d WHEN '0' THEN 'not JSON' WHEN '1' THEN 'not an object' WHEN '2' THEN 'messages is not array' WHEN '3' THEN 'blank' WHEN '4' THEN 'no messages' WHEN '5' THEN 'not JSON' ELSE 'good' END AS state,
 count(*) AS n_lines, sum(CASE WHEN d IN ('0', '1', '2', '3', '4', '5') THEN 0 ELSE n END)::BIGINT AS n_messages FROM h GROUP BY 1""")
def conv_damaged_lines(spark, sf_dir):
    """Conversations written as lines, a share of them damaged, and read back."""
    path = scratch_dir(spark, "damaged")
    sizes = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    rows = _as_records(spark, sf_dir, keep="conv_id").join(sizes, "conv_id")
    wire = F.to_json(F.struct(*jsonl.RECORD.names))
    d = F.substring(F.md5(F.concat_ws("|", F.lit("line"), "conv_id", "n").cast("binary")), 1, 1)
    line = (
        F.when(d == "0", F.substring(wire, 1, 30)).when(d == "1", F.concat(F.lit("["), wire, F.lit("]"))).when(d == "2", F.lit('{"messages": 5}')).when(d == "3", "  ")
        .when(d == "4", F.lit('{"metadata": null}')).when(d == "5", F.concat(wire, F.lit(" {}"))).otherwise(wire)
    )
    rows.select("conv_id", "n", F.lit(None).cast(jsonl.TOOLS).alias("tools"), "messages", "localization", "metadata").select(line.alias("value")).write.text(path)
    found = records.scan(spark, path)
    return found.groupBy(F.coalesce("reason", F.lit("good")).alias("state")).agg(F.count(F.lit(1)).alias("n_lines"), F.coalesce(F.sum(F.size("messages").cast("long")), F.lit(0)).alias("n_messages"))


_KEY = "CASE WHEN event_type IN ('view', 'click') THEN 'src0' ELSE concat('src', user_id % 25) END"


@query(f"""WITH p AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5('7|perm|' || source || '|' || doc_id), doc_id) AS k, count(*) OVER (PARTITION BY source) AS n FROM documents),
e AS (SELECT event_id, {_KEY} AS source, {_u('fresh', 7, 'event_id')} < {FRESH}::DOUBLE AS fresh, {_u('intent', 7, 'event_id')} AS u FROM events),
c AS (SELECT e.*, n, sum(fresh::INT) OVER (PARTITION BY e.source ORDER BY event_id) AS c FROM e LEFT JOIN (SELECT DISTINCT source, n FROM p) USING (source)),
r AS (SELECT *, CASE WHEN fresh AND c <= n THEN c END AS fresh_rank FROM c)
SELECT event_id, r.source, fresh_rank::BIGINT AS fresh_rank, doc_id FROM r LEFT JOIN p ON p.source = r.source AND p.k = coalesce(fresh_rank, floor(u * r.n)::BIGINT + 1)""")
def event_document_picks(spark, sf_dir):
    """For each event a document of its source, without replacement while the source lasts; two event types in five share one source."""
    rows = _t(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.expr(_KEY).alias("key"))
    pool = _t(spark, sf_dir, "documents").select(F.col("source").alias("key"), F.col("doc_id").alias("id"))
    return picks.without_replacement(rows, pool, 7).select(F.col("id").alias("event_id"), F.col("key").alias("source"), "fresh_rank", F.col("pick").alias("doc_id"))


@query("""WITH w AS (SELECT doc_id, octet_length(encode(text)) AS weight FROM documents), s AS (SELECT doc_id, sum(weight) OVER (ORDER BY doc_id) AS until, weight FROM w WHERE weight > 0),
t AS (SELECT max(until) AS total FROM s),
d AS (SELECT event_id, least(floor(('0x' || substr(md5('11|weight|' || event_id), 1, 13))::BIGINT / 4503599627370496::DOUBLE * total::DOUBLE)::BIGINT, total - 1) AS x FROM events, t)
SELECT event_id, doc_id FROM d JOIN s ON x >= until - weight AND x < until""")
def event_draws_by_size(spark, sf_dir):
    """For each event a document, as likely as its bytes are many."""
    table = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.octet_length("text").alias("weight"))
    return picks.by_weight(_t(spark, sf_dir, "events").select(F.col("event_id").alias("id")), table, 11).select(F.col("id").alias("event_id"), F.col("pick").alias("doc_id"))


def _labelled(spark, sf_dir):
    return _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left").select(F.col("source").alias("dataset"), F.col("doc_id").alias("id"), "lang", "quality")


@query(SQL["report_grouping_sets"])
def report_by_batches(spark, sf_dir):
    """report_grouping_sets from partial counts of batches of 5,000 ids, the first batch added twice."""
    state = scratch_dir(spark, "report-state")
    partials = increments.partial_counts(_labelled(spark, sf_dir), ["lang", "quality"], F.floor(F.col("id") / BATCH))
    increments.add_batches(partials, state)
    increments.add_batches(partials.where("batch = 0"), state)
    return increments.merged(spark, state).withColumn("pct", F.round("pct", 6))


@query("""WITH h AS (SELECT DISTINCT conv_id, ('0x' || substr(md5('half|' || conv_id), 1, 1))::INT < 8 AS early FROM conversations),
r AS (SELECT role, count(*) AS n, sum(octet_length(encode(text)))::BIGINT AS n_bytes FROM conversations GROUP BY role)
SELECT role, n, n_bytes, (SELECT count(*) FILTER (early) FROM h) AS early_conversations, (SELECT count(*) FROM h) AS conversations FROM r""")
def stream_role_totals(spark, sf_dir):
    """Totals by role that a stream keeps over files of conversations: it runs over one half of them, stops, and goes on from its checkpoint when the rest is there."""
    path = scratch_dir(spark, "totals")
    rows = _as_records(spark, sf_dir, keep="conv_id")
    early = F.conv(F.substring(F.md5(F.concat(F.lit("half|"), F.col("conv_id").cast("string")).cast("binary")), 1, 1), 16, 10).cast("int") < 8
    seen = []
    for half in (early, ~early):
        jsonl.records(rows.where(half)).write.mode("append").json(f"{path}/in")
        stream = counts.lines_of(spark, f"{path}/in", files_per_batch=3).where("reason IS NULL").select(F.explode("messages").alias("m")).select("m.*")
        counts.total_batches(stream, ["role"], {"n": F.lit(1), "n_bytes": F.octet_length("content").cast("long")}, f"{path}/out", f"{path}/checkpoint")
        seen.append(records.scan(spark, f"{path}/in").where("reason IS NULL").count())
    totals = counts.latest(spark.read.schema("role string, n long, n_bytes long, batch long").parquet(f"{path}/out"), ["role"])
    return totals.withColumns({"early_conversations": F.lit(seen[0]).cast("long"), "conversations": F.lit(seen[1]).cast("long")})


@query("""WITH p AS (SELECT doc_id, lang, row_number() OVER (ORDER BY md5('7|' || doc_id), doc_id) - 1 AS pos, count(*) OVER () AS c FROM documents)
SELECT lang, count(*) AS n, sum(doc_id)::BIGINT AS id_sum, sum(doc_id * 2)::BIGINT AS changed_sum FROM p WHERE pos >= floor(c * 0.70::DOUBLE)::BIGINT AND pos < floor(c * 0.70::DOUBLE)::BIGINT + floor(c * 0.15::DOUBLE)::BIGINT GROUP BY lang""")
def split_read_back(spark, sf_dir):
    """The three splits as folders; one of them rewritten alone, and read back without the other two."""
    path = scratch_dir(spark, "splits")
    made = split.split_70_15_15(_t(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 7).drop("pos").withColumn("note", F.lit(0).cast("long"))
    split.write_splits(made, path)
    changed = written(split.read_split(spark, path, "eval", made.schema).withColumn("note", F.col("doc_id") * 2), "eval")
    split.write_splits(changed, path)
    return split.read_split(spark, path, "eval", made.schema).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("id_sum"), F.sum("note").alias("changed_sum"))


@query()
def conv_until_clean(spark, sf_dir):
    """Conversations with damaged payloads, reviewed and repaired until nothing changes: rounds and the codes that are left."""
    done = repair.until_clean(payload_records(payload_turns(_t(spark, sf_dir, "conversations"))))
    return done.select(F.col("id").alias("conv_id"), "rounds", F.array_join("codes", " ").alias("codes"), F.size("messages").alias("n_messages"))
