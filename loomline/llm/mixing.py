"""Mixing sources to target weights, by blocks.

The words of each source form one stream, documents in a fixed order, cut into blocks of `block` words. A source's
target is a number of draws from its blocks: whole passes over all of them, then part of a pass whose last draw is cut so
that the source gives exactly its target, rounded. Each output shard's slots are shared out by multinomial draws
over what the sources still have to give (the draws of the last shard are what is left). The j-th draw of a source is an index
of its stream: a keyed Feistel network permutes the indexes of whole blocks anew for each pass; a shorter last block ends the
pass. Slots find their blocks by joining on (source, index).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm.common import WORD_RE, bounded_batches, mix, running_offset, small_table, staged

WEIGHTS = (5, 2, 1)
#: Sources that the driver plans for, a row each and one for each output shard; more raise an error before anything is gathered.
MOST_SOURCES = 10_000


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, most: float = 3) -> dict[str | None, float]:
    """Each source's share of all words. Sources by code point, null last, weigh weights in turn; what a target has above
    most * size is shared again by weight among the others, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out = float(sum(sizes.values())), {}
    free = list(names)
    while free:
        left, scale = total - sum(out.values()), sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / scale > most * sizes[s]]
        if not above:
            return out | {s: left * weight[s] / scale for s in free}
        out |= {s: float(most * sizes[s]) for s in above}
        free = [s for s in free if s not in out]
    return out


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 for each key, at index: four Feistel rounds on an even number of bits, walked until below n."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2).astype(float))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    key = mix(key.astype(np.uint64))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for i in range(4):
            left, right = right, left ^ (mix(right + k + np.uint64(i * 0x632BE59BD9B4E019 & (1 << 64) - 1)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def shard_draws(total: list[int], shards: int, seed: int) -> np.ndarray:
    """Draws of each source (column) in each output shard (row): multinomial, within what is left; columns add up to total."""
    rng = np.random.default_rng(seed)
    left = np.array(total, np.int64)
    slots = int(left.sum())
    out = np.zeros((shards, len(total)), np.int64)
    for k in range(shards):
        want = slots * (k + 1) // shards - slots * k // shards
        while want:
            room = left - out[k]
            drawn = np.minimum(rng.multinomial(want, room / room.sum()), room)
            out[k] += drawn
            want -= int(drawn.sum())
        left -= out[k]
    return out


@dataclass
class Mix:
    """rows: row, doc_id, source, key, size, start, and doc if carried; sources: key to (size, target);
    slots: shard, slot, key, pass, block, take; whole: passes that take all of a source, by key."""

    rows: DataFrame
    sources: dict[str, tuple[int, float]]
    slots: DataFrame
    block: int


def plan_mix(docs: DataFrame, carry: bool, block: int = 512, shards: int = 64, seed: int = 7, weights: tuple[float, ...] = WEIGHTS) -> Mix:
    """Lay out the sources and draw the mix; carry keeps each row's columns, as the struct doc. Sizes are words (null text: 0); sources are few enough for the driver (one row each)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD_RE)), F.lit(0)).cast("long")
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    rows = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), key.alias("key"), size.alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc"), *([F.struct(*docs.columns).alias("doc")] if carry else [])), "sized")
    sums = rows.groupBy("key").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")).limit(MOST_SOURCES + 1).collect()
    if len(sums) > MOST_SOURCES:
        raise ValueError(f"over {MOST_SOURCES} sources: group them before mixing")
    found = {r["key"]: (r["n"], r["rows"]) for r in sums}
    want = targets({k[1:] if k else None: n for k, (n, _) in found.items()}, weights)
    sources = {k: (n, want[k[1:] if k else None]) for k, (n, _) in found.items()}
    narrow = running_offset(rows.select("row", "doc_id", "source", "key", "size", "crc"), ["key"], ["doc_id", "size", "crc"], "start", value="size", rows=sum(n for _, n in found.values()))

    names = sorted(k for k, (n, t) in sources.items() if round(t) > 0)
    plan = []
    for k in names:
        n, take = sources[k][0], round(sources[k][1])
        passes, rest = divmod(take, n)
        plan.append((passes * -(-n // block) + -(-rest // block), rest))
    drawn = shard_draws([x for x, _ in plan], shards, seed)
    before = np.cumsum(drawn, axis=0) - drawn
    # a row a source comes from the driver; its shards' cells are made in Spark
    each = [(k, sources[k][0], *plan[i], zlib.crc32(f"{seed}|{k}".encode()), drawn[:, i].tolist(), before[:, i].tolist()) for i, k in enumerate(names)]
    each = small_table(spark, each, {"key": pa.string(), **{c: pa.int64() for c in ("n", "all", "rest", "seed")}, "draws": pa.list_(pa.int64()), "before": pa.list_(pa.int64())})
    cells = each.select("key", "n", "all", "rest", "seed", F.posexplode(F.arrays_zip("draws", "before")).alias("shard", "x")).select("key", "n", "all", "rest", "seed", "shard", "x.draws", "x.before").where("draws > 0")
    step = 1 << 16
    lots = cells.withColumn("lot", F.explode(F.expr(f"sequence(0L, (draws - 1) div {step})")))
    lots = lots.repartition("shard", "key", "lot") if sum(x for x, _ in plan) > step else lots
    draws = lots.withColumn("draw", F.explode(F.expr(f"sequence(before + lot * {step}, before + least(draws, (lot + 1) * {step}) - 1)")))
    per_pass, full = F.expr(f"(n + {block} - 1) div {block}"), F.expr(f"n div {block}")

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, whole, key, turn = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("index", "whole", "seed", "pass"))
            inside, out = index < whole, index.copy()
            out[inside] = permuted(index[inside], whole[inside], (key * 1_000_003 + turn)[inside])
            yield batch.append_column("block", pa.array(out))

    draws = draws.select("shard", "key", "n", "all", "rest", "seed", "draw", (F.col("draw") / per_pass).cast("long").alias("pass"), (F.col("draw") % per_pass).alias("index"), full.alias("whole"))
    draws = draws.mapInArrow(permute, T.StructType([*draws.schema, T.StructField("block", T.LongType())]))
    long = F.when(F.col("block") < full, F.lit(block)).otherwise(F.col("n") % block)
    take = F.when((F.col("draw") == F.col("all") - 1) & (F.col("rest") > 0), (F.col("rest") - 1) % block + 1).otherwise(long)
    slots = draws.select("shard", F.xxhash64("seed", "draw").alias("slot"), "key", "pass", "block", take.cast("long").alias("take"))
    # by sorting both sides: the rows' columns grow with the corpus, however small their file looks
    full = narrow.join(rows.select("row", "doc").hint("merge"), "row") if carry else narrow
    return Mix(full, sources, slots, block)


def taken_pieces(mix: Mix) -> DataFrame:
    """shard, slot, row, pass, block, from_word, to_word: what each slot of each output shard takes of each document, in words of that document.
    Blocks join by index."""
    b = mix.block
    pieces = mix.rows.where("size > 0").select("row", "key", "start", "size", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})")).alias("block"))
    # by sorting both sides: Spark takes the slots for as few as the cells that they are exploded from, but they grow with the corpus
    met = pieces.join(mix.slots.select("shard", "slot", "key", "block", "pass", "take").hint("merge"), ["key", "block"])
    origin = F.col("block") * b
    first, last = F.greatest(F.col("start"), origin), F.least(F.col("start") + F.col("size"), origin + F.col("take"))
    return met.where(last > first).select("shard", "slot", "row", "pass", "block", (first - F.col("start")).alias("from_word"), (last - F.col("start")).alias("to_word"))


def mix_sources(docs: DataFrame, block: int = 512, shards: int = 64, seed: int = 7, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row.

    size is the text's words (null: 0), target the source's, taken the words of the document that the mix takes, repeats
    counted. Null is a source of its own, after the others. Documents without words are never taken. Repeated rows are rows like
    others. An empty table gives an empty result. The same table gives the same mix. Over MOST_SOURCES sources raise an error.
    """
    mix = plan_mix(docs, False, block, shards, seed, weights)
    taken = taken_pieces(mix).groupBy("row").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    about = small_table(docs.sparkSession, [(k, n, t) for k, (n, t) in mix.sources.items()], {"key": pa.string(), "source_size": pa.int64(), "target": pa.float64()})
    return mix.rows.join(F.broadcast(about), "key").join(taken, "row", "left").select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_documents(docs: DataFrame, block: int = 512, shards: int = 64, seed: int = 7, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """The mix as documents, in the columns of docs: a row for each pass that takes words of a document.

    A pass that takes all of a document has its text as it is; one that takes some blocks of it has these words, in
    order, with one space between. n_chars, where present, is counted anew.
    """
    mix = plan_mix(docs, True, block, shards, seed, weights)
    parts = taken_pieces(mix).groupBy("row", "pass").agg(F.sort_array(F.collect_list(F.struct("from_word", "to_word"))).alias("ranges"), F.sum(F.col("to_word") - F.col("from_word")).alias("words"))
    met = mix.rows.select("row", "size", "doc").join(parts, "row")
    partly = F.col("words") < F.col("size")
    words: Column = F.filter(F.split("doc.text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    some = F.array_join(F.flatten(F.transform("ranges", lambda r: F.slice(words, (r["from_word"] + 1).cast("int"), (r["to_word"] - r["from_word"]).cast("int")))), " ")
    doc = F.col("doc").withField("text", F.when(partly, some).otherwise(F.col("doc.text")))
    if "n_chars" in docs.columns:
        doc = doc.withField("n_chars", F.length(doc["text"]).cast(docs.schema["n_chars"].dataType))
    return met.select(doc.alias("doc")).select("doc.*")
