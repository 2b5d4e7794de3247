"""Best-fit packing by length-histogram planning.

The corpus is tokenised and cut into pieces once. The driver sees only the histogram of piece lengths (one row a length,
`capacity` rows at most) and runs best-fit decreasing over its counts: all pieces of one length are placed
together, so planning takes the same time for a thousand documents as for a trillion. Pieces then take the planned slots
by an equality join on length and bucket of the rank within it; a bucket holds two planned entries on average, at most.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import id_and_text, running_offset, small_table, staged, text_slices
from loomline.llm.tokens import crc32_of_ids, encode_ids

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"
SLOTS = ("length", "rank_from", "rank_to", "first_sequence", "sequences", "base", "bucket")


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): every text's ids, end_id after them, cut where longer than capacity.

    A null or empty text is one piece that holds end_id alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                ids, at = encode_ids(data, offsets, tokenizer_path)
                n = np.diff(at) + 1
                full = np.full(len(ids) + len(n), end_id, np.int32)
                ends = np.cumsum(n)
                keep = np.ones(len(full), bool)
                keep[ends - 1] = False
                full[keep] = ids
                pieces = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = number * capacity
                length = np.minimum(capacity, n[row] - start)
                begin = (ends - n)[row] + start
                crc = [crc32_of_ids(full[b : b + k]) for b, k in zip(begin.tolist(), length.tolist(), strict=True)]
                columns = [part.column("doc_id").take(pa.array(row)), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.r_[begin, len(full)].astype(np.int32)), pa.array(full)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    return id_and_text(docs).mapInArrow(cut, PIECE if with_ids else PIECE.rpartition(", ")[0])


def plan_best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Each entry (length, rank_from, rank_to, first_sequence, sequences, base) says: the pieces of that length with
    ranks from rank_from and below rank_to go to `sequences` sequences from first_sequence on, one layer after the other;
    a layer is `length` wide, the first one begins at base.
    """
    open_bins: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges of sequences
    rooms: list[int] = []  # the keys of open_bins, sorted
    made = 0
    plan = []

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in open_bins:
                open_bins[room] = []
                insort(rooms, room)
            open_bins[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, bins = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room], rooms[i]
            else:
                room, first, bins = capacity, made, max(1, left // (capacity // length))
                made += bins
            each = room // length
            filled = min(bins, left // each)
            if filled:
                put(room, first + filled, bins - filled)
            else:
                each, filled = left, 1
                put(room, first + 1, bins - 1)
            put(room - each * length, first, filled)
            plan.append((length, rank, rank + each * filled, first, filled, capacity - room))
            rank += each * filled
            left -= each * filled
    return plan


def by_rank_bucket(plan: list[tuple[int, int, int, int, int, int]], histogram: dict[int, int]) -> tuple[list[tuple[int, ...]], dict[int, int]]:
    """The plan's entries, each once for every bucket of ranks that it reaches into, and the width of each length's buckets.

    A length has as many buckets as entries at most, so an entry comes less than twice on average, however uneven the entries are.
    """
    entries = Counter(entry[0] for entry in plan)
    width = {length: -(-histogram[length] // n) for length, n in entries.items()}
    return [(*entry, bucket) for entry in plan for bucket in range(entry[1] // width[entry[0]], (entry[2] - 1) // width[entry[0]] + 1)], width


def best_fit_pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents (see token_pieces) with sequence_id and offset, their place in sequences of `capacity` tokens.

    Null and empty texts are pieces of one token. Pieces of equal length are ranked by doc_id, piece and crc32; repeated
    rows are placed as often as they come. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    pieces = staged(token_pieces(docs, tokenizer_path, capacity, end_id, with_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    entries, width = by_rank_bucket(plan_best_fit(histogram, capacity), histogram)
    plan, widths = small_table(spark, entries, {c: pa.int64() for c in SLOTS}), small_table(spark, list(width.items()), {"length": pa.int64(), "width": pa.int64()})
    ranked = running_offset(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "rank", rows=sum(histogram.values()))
    bucketed = ranked.join(F.broadcast(widths), "length").withColumn("bucket", F.expr("rank div width"))
    placed = bucketed.join(F.broadcast(plan), ["length", "bucket"]).where("rank >= rank_from AND rank < rank_to")
    at = F.col("rank") - F.col("rank_from")
    return placed.select(
        *pieces.columns,
        (F.col("first_sequence") + at % F.col("sequences")).alias("sequence_id"),
        (F.col("base") + F.floor(at / F.col("sequences")).cast("long") * F.col("length")).alias("offset"),
    )
