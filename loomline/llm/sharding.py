"""Sharding by vector bin packing: bytes, tokens and rows balance jointly.

Groups of equal texts are the items. A group that alone exceeds a shard's even share in any dimension is split into as many parts as
it has shares. Items above 1/HEAVY of a share (at most 3 * HEAVY * shards of them, as shares add up to one) are placed
first, on the driver. All others are dealt by hash to partitions of bounded size; each partition places its items
by the same rule within its part of the shards' residual capacities, so the partitions need not talk to each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import WORD_RE, id_and_text, running_offset, staged

HEAVY = 64
DIMENSIONS = ["bytes", "tokens", "rows"]
#: Items one task places.
PER_TASK = 200_000


def place(items: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """A shard for each item (bytes, tokens, rows), largest first: that with the highest dot product of item and residual capacity.

    items and residual are in shares of a shard; residual (shards x 3) is drawn down in place. Ties go to the lowest shard.
    """
    shards = np.zeros(len(items), np.int32)
    for i in np.argsort(-items.max(axis=1), kind="stable"):
        shards[i] = s = int((residual @ items[i]).argmax())
        residual[s] -= items[i]
    return shards


def vector_shards(docs: DataFrame, shards: int = 40, overhead: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row; law `bytes`: the shards' sizes come out near equal.

    size is the UTF-8 bytes of the text (null: none) plus overhead; tokens are words. Null and empty texts are one group.
    slot counts from 0 within a shard, by doc_id (null first) within hash buckets. Repeated rows are rows like others. An
    empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    rows = id_and_text(docs).select(
        "doc_id",
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD_RE)), F.lit(0)).cast("long").alias("tokens"),
    )
    rows = staged(rows, "rows")
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = rows.agg(*sums).first()
    share = np.array([max(1.0, (total[d] or 0) / shards) for d in DIMENSIONS])
    parts = F.ceil(F.greatest(*[F.col(d) / float(x) for d, x in zip(DIMENSIONS, share, strict=True)])).cast("int").alias("parts")
    # fewer than 3 * shards groups can exceed a share
    split = rows.groupBy("key").agg(*sums).select("key", parts).where("parts > 1")
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("parts"))).cast("int").alias("part")
    rows = staged(rows.join(F.broadcast(split), "key", "left").select(*rows.columns, part), "parted")
    items = staged(rows.groupBy("key", "part").agg(*sums), "items")

    heavy = F.greatest(*[F.col(d) * float(HEAVY / x) for d, x in zip(DIMENSIONS, share, strict=True)]) > 1
    large = sorted(items.where(heavy).collect(), key=lambda r: (r["key"], r["part"]))
    residual = np.ones((shards, 3))
    placed = place(np.array([[r[d] for d in DIMENSIONS] for r in large], float).reshape(-1, 3) / share, residual)
    spark = docs.sparkSession
    first = spark.createDataFrame([(r["key"], r["part"], int(s)) for r, s in zip(large, placed, strict=True)], "key string, part int, shard int")

    light = items.where(~heavy)
    left = light.agg(F.count(F.lit(1)).alias("n"), *[F.sum(d).alias(d) for d in DIMENSIONS]).first()
    whole = np.array([max(1.0, left[d] or 0) for d in DIMENSIONS]) / share

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b for b in batches if b.num_rows]
        if not own:
            return
        table = pa.Table.from_batches(own).sort_by([("key", "ascending"), ("part", "ascending")])
        vectors = np.column_stack([table.column(d).to_numpy() for d in DIMENSIONS]) / share
        shard = place(vectors, residual * (vectors.sum(axis=0) / whole))
        yield from table.select(["key", "part"]).append_column("shard", pa.array(shard)).to_batches()

    spread = light.repartition(max(1, -(-(left["n"] or 0) // PER_TASK)), "key", "part")
    rest = staged(spread.mapInArrow(deal, "key string, part int, shard int"), "placed")
    # rows of heavy items take their shard by broadcast, so that no copy-rich text gathers in one task
    known = rows.join(F.broadcast(first), ["key", "part"], "left")
    with_shard = known.where("shard IS NOT NULL").unionByName(rows.join(F.broadcast(first), ["key", "part"], "left_anti").join(rest, ["key", "part"]))
    numbered = running_offset(staged(with_shard.select("doc_id", "size", "text_crc32", "shard"), "sharded"), ["shard"], ["doc_id", "text_crc32"], "slot", rows=total["rows"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
