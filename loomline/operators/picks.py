"""Draws from tables of any size: without replacement by key, and with weights that a table gives.

Both need a running sum in an exact order, over keys or tables that no task could hold (operators.fold); the rest are joins on numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.draws import uniform
from loomline.functions.tables import written
from loomline.operators.fold import running
from loomline.operators.sampler import FRESH

#: Rows of a pool that may be broadcast (their key, number and id); a larger one is shuffled.
BROADCAST_ROWS = 500_000
#: Picks that one copy of a pool's item answers; an item with more has more copies.
PER_COPY = 50_000


def without_replacement(rows: DataFrame, pool: DataFrame, seed: int, fresh: float = FRESH) -> DataFrame:
    """rows (id, key) with fresh_rank and pick, an id of pool (key, id): the diversity sampler over tables.

    A row is fresh with probability `fresh`. The k-th fresh row of a key, in the order of id, takes item k of the seeded permutation of the key's pool, as long as it
    lasts; all other rows pick any item, each as likely. A key without a pool, or a null one, picks null. Ids of rows must differ, and those of a key's pool too. A key may hold
    most rows: its running count goes on through several tasks, and its items are copied as often as its picks need.
    """
    permutation = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("perm"), F.col("key").cast("string"), F.col("item").cast("string")).cast("binary"))
    items = pool.select("key", F.col("id").alias("item")).where("key IS NOT NULL").withColumn("order", permutation)
    items = written(running(items, ["key"], ["order", "item"], sums={"k": F.lit(1)}).select("key", "k", "item"), "pool")
    sizes = items.groupBy("key").agg(F.max("k").alias("n"))
    is_fresh = uniform("fresh", seed, F.col("id")) < F.lit(fresh)
    marked = running(rows.select("id", "key").withColumn("is_fresh", is_fresh), ["key"], ["id"], sums={"c": F.col("is_fresh").cast("int")}, part="part")
    asked = marked.groupBy("key").agg(F.count(F.lit(1)).alias("asked"))
    sizes = written(sizes.join(asked, "key").withColumn("copies", F.ceil(F.col("asked") / (F.col("n") * PER_COPY)).cast("int")), "pool-sizes")
    # keys come to rows part by part, so that no task gets all rows of one
    where = marked.select("key", "part").distinct().join(sizes, "key")
    met = marked.join(where.select("key", "part", "n", "copies"), ["key", "part"], "left")
    rank = F.when(F.col("is_fresh") & (F.col("c") <= F.col("n")), F.col("c"))
    number = F.coalesce(rank, F.floor(uniform("intent", seed, F.col("id")) * F.col("n")).cast("long") + 1)
    met = met.select("id", "key", rank.alias("fresh_rank"), number.alias("k"), F.pmod(F.xxhash64("id"), F.col("copies")).cast("int").alias("copy"))
    copied = items.join(F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes, "key").select("key", "k", "item", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    copied = F.broadcast(copied) if copied.count() <= BROADCAST_ROWS else copied
    none = met.where("k IS NULL").select("id", "key", "fresh_rank", F.lit(None).cast(pool.schema["id"].dataType).alias("pick"))
    return met.where("k IS NOT NULL").join(copied, ["key", "k", "copy"]).select("id", "key", "fresh_rank", F.col("item").alias("pick")).unionByName(none)


def wide_uniform(stream: str, seed: int, row: Column) -> Column:
    """A number from 0 below 1 of 52 bits of md5('seed|stream|row'), enough to reach every row of a table of 2^52 units of weight."""
    key = F.concat_ws("|", F.lit(str(seed)), F.lit(stream), row.cast("string"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


#: Buckets that one row's list of them names at most; a row of more has more lists.
_LIST = 4096


def by_weight(rows: DataFrame, table: DataFrame, seed: int) -> DataFrame:
    """rows (id) with pick, an id of table (id, weight), each drawn as often as its weight says; weights are whole numbers, null or below one is none.

    The table's running weights are cut into as many buckets of equal weight as it has rows. A table row is entered in each bucket that it reaches into, less than
    twice on average; a draw falls into one bucket and meets only the few rows there, by an equality join. Draws are even over buckets, whatever the
    weights are. Without any weight the picks are null.
    """
    weighed = table.select("id", F.greatest(F.coalesce(F.col("weight").cast("long"), F.lit(0)), F.lit(0)).alias("weight")).where("weight > 0")
    sums = written(running(weighed, [], ["id"], sums={"until": F.col("weight")}).withColumn("from", F.col("until") - F.col("weight")).select(F.col("id").alias("pick"), "from", "until"), "weights")
    total, n = sums.agg(F.max("until"), F.count(F.lit(1))).first()
    if not n:
        return rows.select("id", F.lit(None).cast(table.schema["id"].dataType).alias("pick"))
    width = -(-total // n)
    starts = sums.select("pick", "from", "until", F.explode(F.expr(f"sequence(`from` div {width}, (until - 1) div {width}, {_LIST}L)")).alias("start"))
    entered = starts.select("pick", "from", "until", F.explode(F.expr(f"sequence(start, least(start + {_LIST - 1}, (until - 1) div {width}))")).alias("bucket"))
    at = F.least(F.floor(wide_uniform("weight", seed, F.col("id")) * F.lit(float(total))).cast("long"), F.lit(total - 1))
    drawn = rows.select("id", at.alias("at")).withColumn("bucket", F.expr(f"at div {width}"))
    return drawn.join(entered, "bucket").where("`from` <= at AND at < until").select("id", "pick")
