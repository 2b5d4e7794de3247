"""Running sums and previous values in the order of a key's rows, whatever the size of a key.

A window function by key puts all rows of a key into one task. Here the rows are dealt by ranges of (key, order), so that a large key goes on
through several tasks; each task runs through its sorted rows once and keeps a few numbers a key. Only a task's first key can have begun in an
earlier task: the tasks' edges, one row a task, say what that key had before, and its rows in this task get that added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.tables import written


def _changes(columns: list[pa.Array], last: list[pa.Scalar] | None) -> np.ndarray:
    """For each row whether its key differs from the row's before it; last: the key of the row before the first."""
    n = len(columns[0]) if columns else 0
    new = np.zeros(n, bool)
    for k, column in enumerate(columns):
        shifted = pa.concat_arrays([pa.array([last[k].as_py() if last else None], column.type), column[: n - 1]])
        both_null = pc.and_(pc.is_null(column), pc.is_null(shifted))
        same = pc.or_(pc.fill_null(pc.equal(column, shifted), False), both_null)
        new |= ~same.to_numpy(zero_copy_only=False)
    if last is None and n:
        new[0] = True
    return new


def running(rows: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column] | None = None, before: dict[str, Column] | None = None, parts: int | None = None, part: str | None = None) -> DataFrame:
    """rows with a long column for each of sums, its total over the key's rows up to and with this one, and a column for each of before, its value
    in the key's row just before (null in the first).

    Null keys are a key like others; null values add nothing. order must tell the rows of a key apart, else it is open which of them comes
    first. No keys: the whole table is one. parts: range partitions (spark.sql.shuffle.partitions, if not given). part: a column for the number
    of the range that a row was dealt to, for to_rows(). An empty table gives an empty result.
    """
    sums, before = sums or {}, before or {}
    by, sort = [f"k{i}" for i in range(len(keys))], [f"o{i}" for i in range(len(order))]
    sum_names, before_names = [f"s{i}" for i in range(len(sums))], [f"b{i}" for i in range(len(before))]
    # the row is one struct, so that its columns' names clash with none of these
    table = rows.select(
        F.struct(*rows.columns).alias("row"),
        *[F.col(k).alias(n) for k, n in zip(keys, by, strict=True)],
        *[F.col(c).alias(n) for c, n in zip(order, sort, strict=True)],
        *[F.coalesce(c.cast("long"), F.lit(0)).alias(n) for c, n in zip(sums.values(), sum_names, strict=True)],
        *[c.alias(n) for c, n in zip(before.values(), before_names, strict=True)],
    )
    kept = ["row", *by, *sum_names, *before_names]
    kinds = {f.name: f for f in table.select(*kept).schema}
    made = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType()), T.StructField("head", T.BooleanType()), *[kinds[c] for c in kept], *[T.StructField(f"p{i}", kinds[n].dataType) for i, n in enumerate(before_names)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, last, head = TaskContext.get().partitionId(), 0, None, True
        total, value = np.zeros(len(sum_names), np.int64), [None] * len(before_names)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [batch.column(c) for c in by]
            new = _changes(columns, last) if by else np.r_[at == 0, np.zeros(n - 1, bool)]
            group = np.cumsum(new)  # 0: the key goes on from the batch before
            first_of = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            of_head = (group == 0) & head if at else group == 1
            head = bool(of_head[-1])
            out = []
            for i, c in enumerate(sum_names):
                x = np.cumsum(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64))
                start = np.r_[0, x][first_of]
                x = x - np.where(group > 0, start, 0) + np.where(group == 0, total[i], 0)
                total[i] = x[-1]
                out.append(pa.array(x))
            earlier = []
            for i, c in enumerate(before_names):
                column = batch.column(c)
                shifted = pa.concat_arrays([pa.array([value[i]], column.type), column[: n - 1]])
                earlier.append(pc.if_else(pa.array(new), pa.scalar(None, column.type), shifted))
                value[i] = column[n - 1].as_py()
            last = [c[n - 1] for c in columns]
            here = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n)), pa.array(of_head)]
            yield pa.RecordBatch.from_arrays([*here, batch.column("row"), *columns, *out, *[batch.column(c) for c in before_names], *earlier], made.names)
            at += n

    range_by = [*by, *sort]
    dealt = table.repartitionByRange(*([parts] if parts else []), *range_by).sortWithinPartitions(*range_by)
    done = written(dealt.select(*kept).mapInArrow(run, made), "running")

    # one row a task: its first key, and what its last key has come to
    key = F.struct(*by) if by else F.struct(F.lit(1).alias("k"))
    state = F.struct(*sum_names, *before_names) if sum_names or before_names else F.struct(F.lit(1).alias("s"))
    edges = done.groupBy("part").agg(F.min_by(key, "at").alias("first"), F.max_by(key, "at").alias("last"), F.max_by(state, "at").alias("state"))
    edges = written(edges, "edges")
    ends = edges.select(F.col("last").alias("key"), "part", F.lit(1).alias("end"), "state")
    begins = edges.select(F.col("first").alias("key"), "part", F.lit(0).alias("end"), F.lit(None).cast(edges.schema["state"].dataType).alias("state"))
    earlier = Window.partitionBy("key").orderBy("part", "end").rowsBetween(Window.unboundedPreceding, -1)
    bases = ends.unionByName(begins)
    bases = bases.select("part", "end", *[F.coalesce(F.sum(f"state.{c}").over(earlier), F.lit(0)).alias(f"base_{c}") for c in sum_names], F.last("state", ignorenulls=True).over(earlier).alias("state")).where("end = 0")
    bases = bases.select("part", *[f"base_{c}" for c in sum_names], "state")
    met = done.join(F.broadcast(bases), "part", "left")
    added = [(F.col(c) + F.when(F.col("head"), F.col(f"base_{c}")).otherwise(0)).alias(n) for n, c in zip(sums, sum_names, strict=True)]
    values = [F.when(F.col("at") == 0, F.col(f"state.{c}")).otherwise(F.col(f"p{i}")).alias(n) for i, (n, c) in enumerate(zip(before, before_names, strict=True))]
    return met.select("row.*", *added, *values, *([F.col("part").alias(part)] if part else []))


def to_rows(rows: DataFrame, facts: DataFrame, keys: list[str], part: str) -> DataFrame:
    """rows (from running(), with its column part) with the columns of facts, a row a key, null where there is none. Facts go to each part that has rows of the key, so that
    no task gets all rows of a large key."""
    key = F.struct(*keys)  # null keys are equal within a struct
    names = [c for c in facts.columns if c not in keys]
    where = rows.select(key.alias("key_"), F.col(part).alias("part_")).distinct()
    sent = where.join(facts.select(key.alias("key_"), F.struct(*names).alias("facts_")), "key_")
    met = rows.withColumns({"key_": key, "part_": F.col(part)}).join(sent, ["key_", "part_"], "left")
    return met.select(*rows.columns, *[F.col(f"facts_.{c}").alias(c) for c in names])
