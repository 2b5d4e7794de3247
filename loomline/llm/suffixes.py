"""Passages that repeat across documents, by sparse suffix arrays.

Suffixes are kept only at minimiser positions: of every STEP windows of WINDOW words in a row, the one with the least hash. The
choice depends on the words alone, so any run of LEAST = WINDOW + STEP - 1 words that two documents share has a chosen suffix in both,
with WINDOW equal words to its right.

The suffixes of all documents are sorted by their first WINDOW words, then by their first LEAST words (as hashes of these, which bring
equal ones side by side), and neighbours of different documents compared: one that shares WINDOW words is a seed, one that shares LEAST is a
match. Matches are then extended left and right: next to them, and around seeds, the runs of LEAST words a word further each are sorted
and compared in the same way. What is found is exact: the words in any run of LEAST words that another document has too.

A sort by (hash, document, position) deals out a very common passage over many tasks, whatever its share of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import hot_keys, id_and_text, join_groups, mix, span_hashes, spans, staged, text_slices, window_hashes, with_known_ids

WINDOW = 30
STEP = 21
LEAST = WINDOW + STEP - 1
_RANK = np.uint64(0x2545F4914F6CDD1D)


def _window_tables(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first word of each row; hashes of the WINDOW and of the LEAST words from each word on, whatever row they are of."""
    starts, ends, first = spans(data, offsets)
    words = span_hashes(data, starts, ends)
    return first, window_hashes(words, WINDOW), window_hashes(words, LEAST)


def minimisers(windows: np.ndarray) -> np.ndarray:
    """Positions of the least hash of every STEP hashes in a row (the first of equal ones); none of fewer."""
    if len(windows) < STEP:
        return np.zeros(0, np.int64)
    rank = mix(windows ^ _RANK)
    return np.unique(np.lib.stride_tricks.sliding_window_view(rank, STEP).argmin(axis=1) + np.arange(len(rank) - STEP + 1))


def suffixes(docs: DataFrame) -> DataFrame:
    """doc_id, pos (in words), h, run: the chosen suffixes of every text, hashes of their first WINDOW and LEAST words (0 where the text ends before)."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                first, windows, runs = _window_tables(data, offsets)
                rows, at, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                    if b - a >= LEAST:
                        found = minimisers(windows[a : b - WINDOW + 1]) + a
                        rows.append(np.full(len(found), i))
                        at.append(found)
                        ends.append(np.full(len(found), b))
                row, where, end = np.concatenate(rows), np.concatenate(at), np.concatenate(ends)
                run = np.zeros(len(where), np.uint64)
                whole = where + LEAST <= end
                run[whole] = runs[where[whole]]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(row)), pa.array((where - first[row]).astype(np.int32)), pa.array(windows[where].view(np.int64)), pa.array(run.view(np.int64))], ["doc_id", "pos", "h", "run"])

    return docs.where("doc_id IS NOT NULL").mapInArrow(choose, "doc_id long, pos int, h long, run long")


def _neighbours(batches: Iterator[pa.RecordBatch], keys: list[str], place: str) -> Iterator[pa.RecordBatch]:
    """Of sorted rows (keys, doc_id, place), those of groups with one first key that several documents are in.

    kind: 0; 1 for rows of the task's first or last group where it shows one document here, as it may go on in another task; 2 for these
    two groups themselves: doc_id is then their first document and place the same, or another number where they show several. whole: another
    document's row has the last key as well, as far as the rows at hand show. Of a group only the rows of its first document are ever held.
    """
    names = [*keys, "doc_id", place]
    doc = len(keys)
    held: np.ndarray | None = None  # the rows of the open group while it shows one document
    key, low, several, leading = None, 0, False, True

    def out(rows: np.ndarray, kind: int, whole: np.ndarray | None = None) -> pa.RecordBatch:
        n = len(rows)
        return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(c)) for c in rows.T), pa.array(np.full(n, kind, np.int32)), pa.array(np.zeros(n, bool) if whole is None else whole)], [*names, "kind", "whole"])

    def group(key: int, several: bool) -> np.ndarray:
        return np.array([[key] * doc + [low, low + int(several)]], np.int64)

    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in names])
        x = x if held is None else np.concatenate([held, x])
        x = x[np.r_[True, (x[1:] != x[:-1]).any(axis=1)]]
        new = np.r_[True, x[1:, 0] != x[:-1, 0]]
        other = np.r_[False, x[1:, doc] != x[:-1, doc]]
        starts = np.flatnonzero(new)
        many = np.logical_or.reduceat(other & ~new, starts)
        goes_on = key is not None and x[0, 0] == key
        many[0] |= goes_on and several
        new_last = new | np.r_[False, x[1:, doc - 1] != x[:-1, doc - 1]]
        last_starts = np.flatnonzero(new_last)
        whole = np.repeat(np.logical_or.reduceat(other & ~new_last, last_starts), np.diff(np.r_[last_starts, len(x)])) & (x[:, doc - 1] != 0)
        if not goes_on:
            if leading and key is not None:  # the first group ended with the batch before
                yield out(group(key, several), 2)
                leading = False
            low = x[0, doc]
        row_many = np.repeat(many, np.diff(np.r_[starts, len(x)]))
        done = np.arange(len(x)) < starts[-1]
        if leading and len(starts) > 1:
            end = starts[1]
            yield out(group(x[0, 0], many[0]), 2)
            if not many[0]:
                yield out(x[:end], 1)
        leading = leading and len(starts) == 1
        if len(starts) > 1:
            low = x[starts[-1], doc]
        key, several = x[-1, 0], bool(many[-1])
        held = None if several else x[starts[-1] :]
        go = row_many & (done | several)
        if go.any():
            yield out(x[go], 0, whole[go])
    if key is not None:
        yield out(group(key, several), 2)
        if held is not None:
            yield out(held, 1)


def with_other_documents(rows: DataFrame, keys: list[str], place: str) -> DataFrame:
    """_neighbours() of staged rows, over one range sort by keys, document and place; without its kinds 1 and 2, which the edges of all tasks,
    two rows each, decide: where kind is 1, whole is only a lower bound."""
    columns = [*keys, "doc_id", place]
    ordered = rows.select(*columns).repartitionByRange(*columns).sortWithinPartitions(*columns)
    schema = ", ".join(f"{c} long" for c in columns) + ", kind int, whole boolean"
    found = staged(ordered.mapInArrow(lambda batches: _neighbours(batches, keys, place), schema), "met")
    edges = found.where("kind = 2").groupBy(keys[0]).agg(F.min("doc_id").alias("low"), F.max(place).alias("high")).where("low < high").select(keys[0])
    undecided = found.where("kind = 1").join(F.broadcast(edges), keys[0], "left_semi")
    return found.where("kind = 0").unionByName(undecided.select(*found.columns)).select(*columns, "whole")


def _known(pos: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that the runs of LEAST words from matches on make up."""
    at = pos[whole]
    if not len(at):
        return at, at
    new = np.r_[True, at[1:] > at[:-1] + LEAST]
    return at[new], np.r_[at[:-1][new[1:]], at[-1]] + LEAST


def _to_extend(pos: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each seed a set of bits: bit o where the run of LEAST words from o words before it isn't in a stretch that is known."""
    bits = np.zeros(len(pos), np.int64)
    todo = np.arange(len(pos))
    if len(starts):
        at = np.maximum(np.searchsorted(starts, pos, "right") - 1, 0)
        todo = np.flatnonzero((pos - STEP + 1 < starts[at]) | (pos + LEAST > ends[at]))
    for lo in range(0, len(todo), 1 << 16):
        part = todo[lo : lo + (1 << 16)]
        begin = pos[part, None] - np.arange(STEP)
        open_ = begin >= 0
        if len(starts):
            at = np.searchsorted(starts, begin, "right") - 1
            open_ &= ~((at >= 0) & (begin + LEAST <= ends[np.maximum(at, 0)]))
        bits[part] = open_ @ (1 << np.arange(STEP))
    return bits


def stretches_and_questions(seeds: DataFrame) -> DataFrame:
    """Of doc_id, seeds (array of pos, h, whole): rows doc_id, a, b of stretches known from matches (start and end), and, with a null doc_id,
    of what must be compared to extend them (h, bits)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("seeds")
            flat, cuts = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            all_pos, all_h, all_whole = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("pos", "h", "whole"))
            docs, a, b = [], [], []
            for doc, i, j in zip(batch.column("doc_id").to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                pos, h = all_pos[i:j], all_h[i:j]
                starts, ends = _known(pos, all_whole[i:j])
                bits = _to_extend(pos, starts, ends)
                asked = np.flatnonzero(bits)
                docs += [doc] * len(starts) + [None] * len(asked)
                a += [starts, h[asked]]
                b += [ends, bits[asked]]
            if docs:
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(np.concatenate(a).astype(np.int64)), pa.array(np.concatenate(b).astype(np.int64))], ["doc_id", "a", "b"])

    return seeds.mapInArrow(work, "doc_id long, a long, b long")


def runs_around(docs: DataFrame) -> DataFrame:
    """run, doc_id, start of docs with seeds (pos, h, bits): the hash of the LEAST words that begin o words before a seed, for each bit o."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                first, windows, runs = _window_tables(data, offsets)
                lists = part.column("seeds")
                flat, cuts = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
                all_pos, all_h, all_bits = (flat.field(c).to_numpy() for c in ("pos", "h", "bits"))
                docs, starts, hashes = [], [], []
                for doc, i, j, a, b in zip(part.column("doc_id").to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                    fits = all_pos[i:j] + WINDOW <= b - a
                    pos, h, bits = (x[i:j][fits] for x in (all_pos, all_h, all_bits))
                    same = windows[a + pos].view(np.int64) == h  # a repeated id may have other texts
                    begin = (pos[same, None] - np.arange(STEP))[(bits[same, None] >> np.arange(STEP) & 1).astype(bool)]
                    begin = np.unique(begin[(begin >= 0) & (begin + LEAST <= b - a)])
                    docs.append(np.full(len(begin), doc))
                    starts.append(begin)
                    hashes.append(runs[a + begin].view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (hashes, docs, starts)], ["run", "doc_id", "start"])

    return docs.mapInArrow(cut, "run long, doc_id long, start long")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, end_word, n_words of each stretch of LEAST (50) words or more that repeats in other documents.

    A stretch is made up of all runs of LEAST words, overlapping or one after the other, that another document has as well, and of nothing else. Words
    are compared as they are. Repeats within one document alone don't count, nor do repeated rows with one doc_id (where such rows
    differ, the stretches of all of them are given). Null texts, null ids and texts of under 50 words give nothing, as does an empty table.
    """
    base = id_and_text(docs)
    chosen = staged(suffixes(base), "suffixes")
    seeds = staged(with_other_documents(chosen, ["h", "run"], "pos"), "seeds")
    of_doc = seeds.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "h", "whole"))).alias("seeds"))  # of one document
    known = staged(stretches_and_questions(of_doc), "stretches")
    asked = staged(known.where("doc_id IS NULL").groupBy(F.col("a").alias("h")).agg(F.bit_or("b").alias("bits")), "asked")
    # all documents with such a seed answer: whoever shares a run has the seed in it
    holders = seeds.select("doc_id", "pos", "h")
    answering = join_groups(holders, asked, ["h"], hot_keys(holders, ["h"], holders.count()), ["doc_id", "pos"]).groupBy("doc_id").agg(F.collect_list(F.struct("pos", "h", "bits")).alias("seeds"))
    answering = staged(answering, "answering")
    live = with_known_ids(base, answering.select("doc_id"), answering.count())  # ids alone are broadcast; the seeds, which grow with the texts, are not
    runs = staged(runs_around(live.join(answering, "doc_id").select("doc_id", "text", "seeds")), "runs")
    found = with_other_documents(runs, ["run"], "start").select("doc_id", F.col("start").alias("a"), (F.col("start") + LEAST).alias("b"))
    parts = known.where("doc_id IS NOT NULL").unionByName(found)
    before = F.max("b").over(Window.partitionBy("doc_id").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("new", F.coalesce((F.col("a") > before).cast("int"), F.lit(1)))
    parts = parts.withColumn("stretch", F.sum("new").over(Window.partitionBy("doc_id").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, 0)))
    out = parts.groupBy("doc_id", "stretch").agg(F.min("a").alias("start_word"), F.max("b").alias("end_word"))
    return out.select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"))
