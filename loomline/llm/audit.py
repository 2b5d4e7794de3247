"""Filter interaction audit by signed parity sums (a Walsh-Hadamard transform).

Each document's failures are a mask of k bits, one a filter. For every part and label class one aggregation adds up the 2^k signed
parity sums: over all documents, +1 or -1 by the parity of the mask's bits within s. They are inverted exactly to how many documents have
each mask; all orders of the filters, and the Shapley values in closed form, then follow from these few cells without another look at
the documents.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import SPACE_RE, staged

#: The audited filters; E, exact copies, is told from the whole table.
FILTERS = "ABCDE"


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """Whether a text (not null) and its words fail each filter that looks at the text alone."""
    n = F.size(words).cast("long")
    upper = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": n < 200,
        "B": F.size(F.array_distinct(words)) * F.lit(100).cast("long") < n * 50,
        "C": upper * F.lit(100).cast("long") > F.length(text) * F.lit(3).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, good, toxic, mask of every row of docs (doc_id, text, lang; other columns aren't looked at).

    A row with a null id has no label and no smaller id, so it fails no E. Of repeated labels of an id any that is 1 counts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    part = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", SPACE_RE), ""))
    failed = text_failures(F.col("text"), F.col("words"))
    mask = sum((F.when(test, 1 << FILTERS.index(name)).otherwise(0) for name, test in failed.items()), F.lit(0))
    rows = staged(rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("key"), mask.alias("mask")), "failures")

    # a text's first row is met by text and id together, so that no task gets all copies of a text
    first = rows.where("doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.lit(True).alias("first"))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    met = rows.where("doc_id IS NOT NULL").join(first, ["key", "doc_id"], "left").join(known, "doc_id", "left")
    copy = F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    met = met.select("part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), (F.col("mask") + copy).alias("mask"))
    return met.unionByName(rows.where("doc_id IS NULL").select("part", F.lit(False).alias("good"), F.lit(False).alias("toxic"), "mask"))


def _sign(bits: Column) -> Column:
    """-1 where an odd number of bits is set, else 1."""
    return F.lit(1).cast("long") - F.lit(2) * F.bit_count(bits).bitwiseAND(F.lit(1))


def parity_sums(masks: DataFrame, k: int) -> DataFrame:
    """part, good, toxic and sums: for each s from 0 to 2^k - 1 the sum of signs of the bits that mask and s share."""
    sums = [F.sum(_sign(F.col("mask").bitwiseAND(F.lit(s)))).alias(f"s{s}") for s in range(1 << k)]
    found = masks.groupBy("part", "good", "toxic").agg(*sums)
    return found.select("part", "good", "toxic", F.array(*[f"s{s}" for s in range(1 << k)]).alias("sums"))


def mask_cells(sums: DataFrame, k: int) -> DataFrame:
    """part and cells: for each mask that any document of the part has, how many have it, and how many of these are good and toxic."""
    n = 1 << k

    def documents(m: Column) -> Column:
        signed = F.transform("sums", lambda x, s: x * _sign(s.bitwiseAND(m)))
        return F.aggregate(signed, F.lit(0).cast("long"), lambda total, x: total + x)

    cell = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda m: F.struct(m.alias("mask"), documents(m).alias("n")))
    each = sums.select("part", "good", "toxic", F.inline(cell)).withColumn("n", F.expr(f"n div {n}"))
    counted = each.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))
    # 2^k cells a part at most
    return counted.where("n > 0").groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))


def audit_orders(cells: DataFrame, names: str) -> DataFrame:
    """A row for each part, order of the filters and step, from the parts' mask cells."""
    k = len(names)
    steps = [{"filter_order": "".join(o), "step": i + 1, "before": sum(1 << names.index(x) for x in o[:i]), "bit": 1 << names.index(o[i])} for o in permutations(names) for i in range(k)]
    plan = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, before: int, bit: int>>")
    rows = cells.select("part", "cells", F.inline(plan))
    before, bit = F.col("before"), F.col("bit")

    def total(test, value) -> Column:
        return F.aggregate(F.filter("cells", test), F.lit(0).cast("long"), lambda found, c: found + value(c))

    n = lambda c: c["n"]
    fails = lambda c: c["mask"].bitwiseAND(bit) != 0
    reached = lambda c: c["mask"].bitwiseAND(before) == 0
    here = lambda c: fails(c) & reached(c)
    # a document that fails f filters is removed by each of them in k!/f of the orders
    share = lambda c: (F.lit(factorial(k)) / F.bit_count(c["mask"])).cast("long") * c["n"]
    return rows.select(
        "part",
        "filter_order",
        "step",
        total(lambda c: reached(c) & ~fails(c), n).alias("kept"),
        total(here, n).alias("removed"),
        total(lambda c: fails(c) & ~reached(c), n).alias("redundant"),
        total(lambda c: c["mask"] == bit, n).alias("unique_fails"),
        total(here, lambda c: c["good"]).alias("good_lost"),
        total(here, lambda c: c["toxic"]).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley of the five filters over docs.

    A row for each value of lang (null: empty), each order of the filters and each step, zeros included. Null texts count as empty; of
    rows with one text those with a larger doc_id than the smallest fail E. An empty table gives an empty result. A text's words
    are held at once by the task that reads it, so texts of over some 50 MB don't fit executors of 3 GB.
    """
    return audit_orders(mask_cells(parity_sums(failure_masks(docs, labels), len(FILTERS)), len(FILTERS)), FILTERS)
