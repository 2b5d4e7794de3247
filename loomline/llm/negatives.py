"""Hard-negative mining by a two-dimensional block matrix product, after the manner of SUMMA.

Anchors and rows are cut into blocks, and each block's vectors into chunks of dimensions. A grid of cells (strip of anchors, strip of
rows, chunk of dimensions) makes partial score tiles; a shuffle adds the partial tiles of a block pair up as int64, and each full tile is reduced
at once to the few best pairs of each anchor. Blocks follow (label, vec_id), so that only block pairs whose label ranges meet
are multiplied for the positives; the negatives take a second product, with the anchors' positives riding on their blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import staged

#: Rows of an anchor block and of a block of all rows: a full tile is 128 x 2048 scores, 2 MB.
ANCHORS, ROWS = 128, 2048
#: Blocks of a strip: what a cell of the grid holds of the anchors, and what it streams of the rows.
ANCHOR_STRIP, ROW_STRIP = 8, 2
#: Bytes of partial tiles that a task of the adding stage reads, about.
TILE_BYTES = 64 << 20
_NONE = np.iinfo(np.int64).min
PANEL = "kind int, block long, low long, high long, chunk int, rows int, width int, matrix binary, ids binary, labels binary"


def usable(table: DataFrame, label: Column, anchor: Column) -> DataFrame:
    """vec_id, label, anchor, v (array<double>) of the rows that take part, one for each vec_id: the least by label, then by components."""
    v = F.col("embedding").cast("array<double>")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), anchor.alias("anchor"), v.alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(~odd)
    again = staged(rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id"), "ids-that-repeat")
    if again.isEmpty():
        return rows
    one = rows.join(again, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "v", "anchor")).alias("x")).select("vec_id", "x.label", "x.anchor", "x.v")
    return rows.join(again, "vec_id", "left_anti").unionByName(one)


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same integers in as few bytes as hold them all."""
    most = int(np.abs(x).max()) if x.size else 0
    return x.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8")


def panels(rows: DataFrame, kind: int, size: int, n: int, dims: int, chunks: int) -> DataFrame:
    """Blocks of about `size` rows in the order of (label, vec_id), a panel (PANEL) for each chunk of dimensions; ids and labels with the first.

    A component becomes floor(256 * x); a vector of fewer than `dims` components ends in zeros.
    """
    cuts = [dims * c // chunks for c in range(chunks + 1)]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal number
            part = pa.Table.from_batches(held).combine_chunks()
            ids, labels, lists = (part.column(c).combine_chunks() for c in ("vec_id", "label", "v"))
            ids, labels = ids.to_numpy(), labels.to_numpy()
            lengths = np.diff(lists.offsets.to_numpy())
            values = np.floor(256.0 * lists.flatten().to_numpy())
            if len(values) and np.abs(values).max() >= 2.0**53:
                raise ValueError("components of 2^45 and more make scores that 53 bits don't hold")
            whole = np.zeros((len(ids), dims), np.int64)
            whole[np.repeat(np.arange(len(ids)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
            for c in range(chunks):
                x = _narrow(whole[:, cuts[c] : cuts[c + 1]])
                first = [ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes()] if c == 0 else [None, None]
                values_ = [kind, number, int(labels.min()), int(labels.max()), c, len(ids), x.itemsize, x.tobytes(), *first]
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values_, kinds, strict=True)], [f.split()[0] for f in PANEL.split(", ")])
            number += 1
            held.clear()

        for batch in batches:
            while batch.num_rows:
                take = size - sum(b.num_rows for b in held)
                held.append(batch.slice(0, take))
                batch = batch.slice(take)
                if sum(b.num_rows for b in held) == size:
                    yield from block()
        if held:
            yield from block()

    # fewer tasks than range partitions, so that blocks are full ones
    ordered = rows.select("vec_id", "label", "v").repartitionByRange("label", "vec_id").sortWithinPartitions("label", "vec_id")
    return ordered.coalesce(max(1, n // (4 * size))).mapInArrow(pack, PANEL)


def partial_tiles(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, chunks: int, same_label: bool) -> DataFrame:
    """Partial score tiles (i, j, chunk): anchor panels (with positives) times row panels. same_label: only of blocks that may share a label; otherwise
    only of blocks that may differ in it. The first chunk's tile carries ids, labels and positives."""
    high, wide = -(-n_anchors // (ANCHORS * ANCHOR_STRIP)), -(-n_rows // (ROWS * ROW_STRIP))
    down, across = F.pmod(F.xxhash64("block"), F.lit(high)).cast("int"), F.pmod(F.xxhash64("block"), F.lit(wide)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("r", down).withColumn("c", every(wide))
    right = rows.withColumn("positives", F.lit(None).cast(POSITIVES)).withColumn("r", every(high)).withColumn("c", across)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                here = tuple(row[c].as_py() for c in ("chunk", "r", "c"))
                if here != cell:
                    cell, held = here, []
                low, high, n = (row[c].as_py() for c in ("low", "high", "rows"))
                x = np.frombuffer(row["matrix"].as_buffer(), f"<i{row['width'].as_py()}").reshape(n, -1).astype(np.float64) if n else np.zeros((0, 0))
                if row["kind"].as_py() == 0:
                    held.append((row, low, high, x, np.abs(x).max(initial=0)))
                    continue
                most = np.abs(x).max(initial=0)
                for a, a_low, a_high, y, a_most in held:
                    if (a_high < low or high < a_low) if same_label else low == high == a_low == a_high:
                        continue
                    if float(most) * float(a_most) * x.shape[1] * chunks >= 2.0**53:
                        raise ValueError("scores of 2^53 and more")
                    tile = _narrow(np.rint(y @ x.T).astype(np.int64))
                    about = [a["ids"], a["labels"], a["positives"], row["ids"], row["labels"]]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((a["block"].as_py(), pa.int64()), (row["block"].as_py(), pa.int64()), (here[0], pa.int32()), (tile.itemsize, pa.int32()), (tile.tobytes(), pa.binary()))] + [pa.array([v.as_py()], v.type) for v in about], ["i", "j", "chunk", "width", "tile", "a_ids", "a_labels", "positives", "ids", "labels"])

    cells = high * wide * chunks
    both = left.unionByName(right).repartition(min(cells, 20_000), "chunk", "r", "c").sortWithinPartitions("chunk", "r", "c", "kind", "block")
    return both.mapInArrow(multiply, f"i long, j long, chunk int, width int, tile binary, a_ids binary, a_labels binary, positives {POSITIVES}, ids binary, labels binary")


POSITIVES = "array<struct<at: int, id: bigint, score: bigint>>"


def reduced(tiles: DataFrame, n_anchors: int, n_rows: int, chunks: int, reduce: Callable[..., pa.RecordBatch | None], schema: str) -> DataFrame:
    """The partial tiles of each pair of blocks added up, and what reduce(i, scores, anchor ids and labels, row ids and labels, positives) makes of the full tile; rows come
    in the order of their ids, so that of equal scores the first is that of the smallest id."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, total, about = None, None, None

        def close() -> Iterator[pa.RecordBatch]:
            if pair is not None:
                a_ids, a_labels, ids, labels, positives = about
                order = np.argsort(ids, kind="stable")
                out = reduce(pair[0], total.reshape(len(a_ids), len(ids))[:, order], a_ids, a_labels, ids[order], labels[order], positives)
                if out is not None and out.num_rows:
                    yield out

        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                here = (row["i"].as_py(), row["j"].as_py())
                tile = np.frombuffer(row["tile"].as_buffer(), f"<i{row['width'].as_py()}")
                if here != pair:
                    yield from close()
                    pair, total = here, tile.astype(np.int64)
                else:
                    total += tile
                if row["chunk"].as_py() == 0:
                    about = [np.frombuffer(row[c].as_py(), "<i8") for c in ("a_ids", "a_labels", "ids", "labels")] + [row["positives"].as_py()]
        yield from close()

    tasks = -(-n_anchors * n_rows * 4 * chunks // TILE_BYTES)
    tasks = max(int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")), tasks)
    return tiles.repartition(tasks, "i", "j").sortWithinPartitions("i", "j", "chunk").mapInArrow(add, schema)


def _best(scores: np.ndarray, fit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best fitting scores of each row (the first of equal ones), as far as there are so many."""
    left = np.where(fit, scores, _NONE)
    rows, found = np.arange(len(left)), []
    for _ in range(min(k, left.shape[1])):
        at = left.argmax(axis=1)
        ok = left[rows, at] != _NONE
        if not ok.any():
            break
        found.append((rows[ok], at[ok]))
        left[rows, at] = _NONE
    none = np.zeros(0, np.int64)
    return (np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])) if found else (none, none)


def hard_negatives(table: DataFrame, label: Column, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, chunks: int = 2) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are the `positives` rows of its label with the highest integer inner products (components floor(256 * x)), without
    itself; a positive's negatives are the first `negatives` rows of other labels with low * positive <= 100 * score <= high * positive. Ties go to
    the smaller vec_id. Rows with a null id, label, vector or component, or one that isn't finite, take no part; of rows that share an id the least by
    label, then components, does. Shorter vectors count as ending in zeros. Components so large that a score might need more
    than 53 bits raise an error. Other columns aren't looked at; an empty table, or one without anchors, gives an empty result.
    """
    rows = staged(usable(table, label, anchor), "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"), F.max(F.size("v")).alias("dims")).first()
    n, n_anchors, dims = size["n"], max(1, size["anchors"]), max(1, size["dims"] or 0)
    chunks = min(chunks, dims)
    left = staged(panels(rows.where("anchor"), 0, ANCHORS, n_anchors, dims, chunks).withColumn("positives", F.lit(None).cast(POSITIVES)), "anchor-panels")
    right = staged(panels(rows, 1, ROWS, n, dims, chunks), "row-panels")

    def positives_of(i, scores, a_ids, a_labels, ids, labels, _) -> pa.RecordBatch:
        at, of = _best(scores, (a_labels[:, None] == labels[None, :]) & (a_ids[:, None] != ids[None, :]), positives)
        columns = [np.full(len(at), i), at.astype(np.int32), a_ids[at], ids[of], scores[at, of]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "at", "anchor_id", "id", "score"])

    tiles = partial_tiles(left, right, n_anchors, max(1, n), chunks, True)
    best = reduced(tiles, n_anchors, max(1, n), chunks, positives_of, "block long, at int, anchor_id long, id long, score long")
    first = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id"))
    chosen = staged(best.withColumn("k", first).where(F.col("k") <= positives), "positives")
    # so many a block: its anchors times their positives
    by_block = chosen.groupBy("block").agg(F.collect_list(F.struct("at", "id", "score")).alias("positives"))
    left = left.drop("positives").join(by_block, "block").withColumn("positives", F.when(F.col("chunk") == 0, F.col("positives")))

    def negatives_of(i, scores, a_ids, a_labels, ids, labels, chosen) -> pa.RecordBatch | None:
        at, of, score = (np.array([p[c] for p in chosen], np.int64) for c in ("at", "id", "score"))
        order = np.argsort(at, kind="stable")
        at, of, score = at[order], of[order], score[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)  # number within its anchor
        out = []
        other = a_labels[:, None] != labels[None, :]
        for k in range(int(place.max()) + 1):
            now = place == k
            part = scores[at[now]]
            least, most = -(-low * score[now] // 100), high * score[now] // 100
            row, column = _best(part, other[at[now]] & (part >= least[:, None]) & (part <= most[:, None]), negatives)
            out.append(np.column_stack([a_ids[at[now]][row], of[now][row], ids[column], score[now][row], part[row, column]]))
        found = np.concatenate(out)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in found.T.astype(np.int64).copy()], ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]) if len(found) else None

    tiles = partial_tiles(left, right, n_anchors, max(1, n), chunks, False)
    found = reduced(tiles, n_anchors, max(1, n), chunks, negatives_of, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
