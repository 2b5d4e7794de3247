"""Exact dedup by composable polynomial fingerprints.

A text is cut into chunks; each chunk has a polynomial hash modulo two primes, and the hash of two parts together is
hash(a) * base^len(b) + hash(b). The chunks of a text of over LONG bytes are rows of their own, dealt out over the tasks, hashed there, and
combined by an aggregate of this length-shifted arithmetic; shorter texts are hashed where they are read. Texts with equal length and
fingerprint are then compared chunk by chunk with the text of their group's first row; one that differs (two texts, one fingerprint) is grouped by
its sha256 instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import BROADCAST_IDS, SEPARATOR, SPACE_RE, hot_keys, id_and_text, join_groups, staged, text_slices

PRIMES = (2**31 - 1, 2**31 - 19)
BASES = (1_000_003, 16_777_619)
CHUNK = 1 << 16
#: Bytes of text from which on the chunks, of so many bytes each, are rows of their own.
LONG = 1 << 20
KEY = ["n_bytes", "fp1", "fp2"]


def normal_parts(text: np.ndarray, size: int) -> Iterator[bytes]:
    """The text with each run of white space as one space, in parts of `size` bytes (the last one shorter; one empty part of an empty text); works on
    `size` bytes at a time, however long the text."""
    held, after_space, any_part = b"", False, False
    for at in range(0, len(text), size):
        block = text[at : at + size]
        space = SEPARATOR[block]
        drop = space & np.r_[after_space, space[:-1]]
        after_space = bool(space[-1])
        held += np.where(space, np.uint8(32), block)[~drop].tobytes()
        if len(held) >= size:
            yield held[:size]
            held, any_part = held[size:], True
    if held or not any_part:
        yield held


def squeeze(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of white space as one space, and the rows' new offsets; runs don't cross rows."""
    space = SEPARATOR[data]
    drop = np.zeros(len(data), bool)
    drop[1:] = space[1:] & space[:-1]
    drop[offsets[:-1][offsets[:-1] < len(data)]] = False
    keep = ~drop
    return np.where(space, np.uint8(32), data)[keep], np.r_[0, np.cumsum(keep)][offsets]


@lru_cache(maxsize=8)
def _descending_powers(prime: int, base: int, n: int) -> np.ndarray:
    """base^(n-1), ..., base, 1 modulo prime."""
    out = np.ones(1, np.int64)
    while len(out) < n:
        out = np.concatenate([out * pow(base, len(out), prime) % prime, out])
    return out[-n:]


def combine(left: int, right: int, right_length: int, prime: int, base: int) -> int:
    """The hash of two parts in a row, from their hashes and the length of the second."""
    return (left * pow(base, right_length, prime) + right) % prime


def fingerprint(text: np.ndarray, chunk: int = CHUNK) -> tuple[int, int]:
    """Two polynomial hashes of an array of bytes; the chunk's size makes no difference to them."""
    out = []
    for prime, base in zip(PRIMES, BASES, strict=True):
        powers = _descending_powers(prime, base, chunk)
        value = 0
        whole = len(text) // chunk
        hashes = [int(text[i * chunk : (i + 1) * chunk].astype(np.int64) @ powers % prime) for i in range(whole)]
        for h in hashes:
            value = combine(value, h, chunk, prime, base)
        if rest := len(text) - whole * chunk:
            value = combine(value, int(text[whole * chunk :].astype(np.int64) @ powers[chunk - rest :] % prime), rest, prime, base)
        out.append(value)
    return out[0], out[1]


def _number(doc_id: str = "doc_id") -> list[Column]:
    """What tells texts apart by id: no_id and number, the id or, where there is none, a hash of the text."""
    return [F.col(doc_id).isNull().alias("no_id"), F.coalesce(F.col(doc_id), F.xxhash64("text")).alias("number")]


def text_parts(docs: DataFrame, long: int = LONG) -> DataFrame:
    """The texts of docs (row, doc_id, no_id, number, text), with runs of white space as one space and null as empty: a row with length, two
    hashes and sha256; of a text of over `long` bytes a row for each part of it, with its bytes still to be hashed, and the whole text's sha256 with the first."""
    names = ["row", "doc_id", "no_id", "number", "part", "raw", "text_sha256", *KEY]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                ids = part.select(names[:4])
                if len(data) > long and part.num_rows == 1:
                    sha = hashlib.sha256()
                    for x in normal_parts(data, long):
                        sha.update(x)
                    for i, x in enumerate(normal_parts(data, long)):
                        rest = [i, x, sha.hexdigest() if i == 0 else None, None, None, None]
                        yield pa.RecordBatch.from_arrays([*ids.columns, *(pa.array([v], t) for v, t in zip(rest, kinds[4:], strict=True))], names)
                    continue
                data, offsets = squeeze(data, offsets)
                texts = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                fp = np.array([fingerprint(x) for x in texts], np.int64).reshape(-1, 2)
                sha = pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in texts], pa.string())
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([*ids.columns, pa.array(np.zeros(n, np.int32)), pa.nulls(n, pa.binary()), sha, pa.array(np.diff(offsets)), pa.array(fp[:, 0].copy()), pa.array(fp[:, 1].copy())], names)

    return docs.mapInArrow(hashed, "row long, doc_id long, no_id boolean, number long, part int, raw binary, text_sha256 string, n_bytes long, fp1 long, fp2 long")


def combined(parts: DataFrame) -> DataFrame:
    """row, n_bytes and two hashes of texts in parts (row, part, raw), which tasks share out."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in batch.column("raw"):
                x = np.frombuffer(raw.as_py(), np.uint8)
                rows.append((len(x), *fingerprint(x), *(pow(base, len(x), prime) for prime, base in zip(PRIMES, BASES, strict=True))))
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("part"), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))], ["row", "part", "n", "h1", "h2", "shift1", "shift2"])

    rows = parts.select("row", "part", "raw").repartition("row", "part").mapInArrow(hashed, "row long, part int, n long, h1 long, h2 long, shift1 long, shift2 long")
    # 50 bytes a part of LONG bytes
    lists = rows.groupBy("row").agg(F.sum("n").alias("n_bytes"), F.sort_array(F.collect_list(F.struct("part", "h1", "h2", "shift1", "shift2"))).alias("parts"))

    def whole(i: int) -> Column:
        return F.aggregate("parts", F.lit(0).cast("long"), lambda value, x: (value * x[f"shift{i + 1}"] + x[f"h{i + 1}"]) % F.lit(PRIMES[i]))

    return lists.select("row", "n_bytes", whole(0).alias("fp1"), whole(1).alias("fp2"))


def fingerprints(docs: DataFrame, long: int = LONG) -> DataFrame:
    """row, doc_id, no_id, number, text_sha256, length and two hashes of each text with runs of white space as one space; null counts as empty."""
    # the row number tells repeated rows apart; it is fixed by the staging
    parts = staged(text_parts(id_and_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", *_number(), "text"), long), "text-parts")
    columns = ["row", "doc_id", "no_id", "number", "text_sha256", *KEY]
    out = parts.where("raw IS NULL").select(*columns)
    huge = parts.where("raw IS NOT NULL")
    if huge.isEmpty():
        return out
    return staged(out.unionByName(huge.where("part = 0").drop(*KEY).join(combined(huge), "row").select(*columns)), "fingerprints")


def text_chunks(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The texts of docs (no_id, number, text), with white space as in fingerprints(), as rows of at most `chunk` bytes: no_id, number, the fingerprint, chunk, bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                ids = list(zip(part.column("no_id").to_pylist(), part.column("number").to_pylist(), strict=True))
                for key, a, b in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    n, fp = 0, [0, 0]
                    for x in normal_parts(data[a:b], chunk):
                        n += len(x)
                        fp = [combine(v, h, len(x), prime, base) for v, h, prime, base in zip(fp, fingerprint(np.frombuffer(x, np.uint8)), PRIMES, BASES, strict=True)]
                    rows: list[tuple] = []
                    for i, x in enumerate(normal_parts(data[a:b], chunk)):
                        rows.append((*key, n, *fp, i, x))
                        if len(rows) == 64:
                            yield batch_of(rows)
                            rows = []
                    if rows:
                        yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.bool_(), *[pa.int64()] * 4, pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["no_id", "number", *KEY, "chunk", "bytes"])

    return docs.mapInArrow(cut, "no_id boolean, number long, n_bytes long, fp1 long, fp2 long, chunk int, bytes binary")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of [\\x20\\x09-\\x0D] is one space; null counts as empty. Of equal texts
    the row with the smallest doc_id stays, null last; of repeated rows with this doc_id one stays. An empty table gives
    an empty result. Columns besides doc_id and text are not looked at.
    """
    table = fingerprints(docs)
    first = F.min(F.struct("no_id", "doc_id", "row", "number")).alias("first")
    groups = staged(table.groupBy(*KEY).agg(first, F.count(F.lit(1)).alias("group_size")).where("group_size > 1"), "groups")
    # all copies of one text have one key
    hot = hot_keys(groups, KEY, groups.agg(F.sum("group_size")).first()[0] or 0, "group_size")
    members = staged(join_groups(table, groups.select(*KEY), KEY, hot, ["row"], "left_semi").select("no_id", "number").distinct(), "members")
    base = id_and_text(docs).select(*_number(), "text")
    base = base.join(F.broadcast(members) if members.count() <= BROADCAST_IDS else members, ["no_id", "number"])
    leader = groups.select(*KEY, F.col("first.no_id").alias("leader_no_id"), F.col("first.number").alias("leader"))
    chunks = staged(join_groups(text_chunks(base), leader, KEY, hot, ["no_id", "number", "chunk"]), "chunks")
    leaders = chunks.where("no_id = leader_no_id AND number = leader").groupBy(*KEY, "chunk").agg(F.min("bytes").alias("leader_bytes"))
    leaders = staged(leaders, "leaders")
    different = join_groups(chunks, leaders, KEY, hot, ["no_id", "number"], more=["chunk"]).where(F.col("bytes") != F.col("leader_bytes")).select("no_id", "number", *KEY).distinct()
    different = staged(different, "different")
    if different.isEmpty():
        found = join_groups(table, groups, KEY, hot, ["row"], "left")
    else:  # equal fingerprints of different texts: sha256 tells them apart
        table = table.join(different.withColumn("apart", F.lit(True)), ["no_id", "number", *KEY], "left").withColumn("within", F.when(F.col("apart"), F.col("text_sha256")).otherwise(""))
        table = staged(table, "regrouped")
        found = table.join(table.groupBy(*KEY, "within").agg(first, F.count(F.lit(1)).alias("group_size")), [*KEY, "within"], "left")
    alone = F.col("first").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("first.row"))).alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs without the rows that exact_duplicates() drops; all columns stay.

    Rows are told by doc_id; where an id has rows that stay and rows that go, or is null, by the text as well.
    """
    found = staged(exact_duplicates(docs), "exact")
    gone = staged(found.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct(), "ids-with-copies")
    small = gone.count() <= BROADCAST_IDS
    both = staged(found.where("kept").join(F.broadcast(gone) if small else gone, "doc_id", "left_semi").select("doc_id").distinct(), "ids-that-repeat")
    gone = staged(gone.join(both, "doc_id", "left_anti"), "gone")
    out = docs.join(F.broadcast(gone) if small else gone, "doc_id", "left_anti")
    if both.isEmpty() and found.where("doc_id IS NULL").isEmpty():
        return out.select(*docs.columns)
    stay = found.where("kept").join(both, "doc_id", "left_semi").unionByName(found.where("kept AND doc_id IS NULL")).select("doc_id", F.col("text_sha256").alias("sha")).distinct()
    sha = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), SPACE_RE, " "), 256)
    doubtful = out.join(both, "doc_id", "left_semi").select(*docs.columns).unionByName(out.where("doc_id IS NULL").select(*docs.columns))
    # the row is one struct, so that its columns' names clash with none of these
    doubtful = doubtful.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("id"), sha.alias("text_sha"))
    one = doubtful.join(stay, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("sha") == F.col("text_sha"))).dropDuplicates(["id", "text_sha"])
    return out.where("doc_id IS NOT NULL").join(both, "doc_id", "left_anti").select(*docs.columns).unionByName(one.select("doc.*"))
