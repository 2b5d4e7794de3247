"""Helpers shared by the corpus operators: staged tables, distributed offsets, words and their hashes in numpy."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space as the contracts name it: [\x20\x09-\x0D].
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
SPACE_RE = "[\\x20\\x09-\\x0D]+"
WORD_RE = "[^\\x20\\x09-\\x0D]+"

#: Bytes of text that one numpy pass works on (a longer text is a pass of its own); temporaries are about 40 times as large, and
#: a worker keeps most of what it once took.
SLICE_BYTES = 512 << 10
#: Ids (8 bytes each) that may be broadcast; beyond it the same join shuffles.
BROADCAST_IDS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one in local mode."""
    if path := spark.conf.get("spark.checkpoint.dir", None):
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="loomline-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: it cuts the lineage and outlives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: list[tuple], columns: dict[str, pa.DataType]) -> DataFrame:
    """Rows that the driver has made, handed on as Arrow: of a list of tuples Spark makes an RDD, for which each executor starts a second set of Python workers and keeps it."""
    lists = zip(*rows, strict=True) if rows else [()] * len(columns)
    return spark.createDataFrame(pa.table([pa.array(list(x), kind) for x, kind in zip(lists, columns.values(), strict=True)], names=list(columns)))


def give_back() -> None:
    """Memory that this worker has freed but still holds goes back to the system; elsewhere than under glibc nothing is done."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches end at 8 MB, so that long texts don't pile up in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id and text alone: what else a table holds can't clash with an operator's own columns."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def unused(columns: list[str], name: str) -> str:
    """The name, with as many underscores after it as it needs to be none of the columns'."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def crc_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n; a null id falls to bucket 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def with_known_ids(docs: DataFrame, ids: DataFrame, n_ids: int) -> DataFrame:
    """docs joined to ids (unique doc_id and more columns): broadcast while ids are few, shuffled otherwise."""
    return docs.join(F.broadcast(ids) if n_ids <= BROADCAST_IDS else ids, "doc_id")


#: Rows of one key that a task may get; the rows of a key with more are shared out.
HOT = 20_000


def hot_keys(rows: DataFrame, keys: list[str], n: int, counted: str | None = None) -> DataFrame | None:
    """keys and pieces_, the number of tasks to share a key's rows, for each key that more than HOT of the n rows have; None if there is none.

    A key counts as hot from n / 500,000 rows on, too, so there are 500,000 of them at most, which may be broadcast. counted: rows is a row a key, and has their number there.
    """
    least = max(HOT, n // 500_000)
    if n <= least:
        return None
    counts = rows.select(*keys, F.col(counted).alias("rows_")) if counted else rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_"))
    hot = staged(counts.where(F.col("rows_") > least).select(*keys, F.ceil(F.col("rows_") / least).cast("int").alias("pieces_")), "hot-keys")
    return None if hot.isEmpty() else hot


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], hot: DataFrame | None, by: list[str], how: str = "inner", more: list[str] | None = None) -> DataFrame:
    """rows joined with groups by keys (and more columns), where hot keys' rows are dealt out by a hash of the columns `by`, and their groups' rows go to each piece."""
    both = [*keys, *(more or [])]
    if hot is None:
        return rows.join(groups, both, how)
    hot = F.broadcast(hot)
    pieces = F.coalesce("pieces_", F.lit(1))
    spread = rows.join(hot, keys, "left").withColumn("piece_", F.pmod(F.xxhash64(*by), pieces).cast("int")).drop("pieces_")
    copies = groups.join(hot, keys, "left").withColumn("piece_", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("pieces_")
    return spread.join(copies, [*both, "piece_"], how).drop("piece_")


def running_offset(table: DataFrame, keys: list[str], order: list[str], out: str, value: str | None = None, rows: int | None = None) -> DataFrame:
    """Add out: the sum of value (or 1) over the rows before this one among those with equal keys.

    Keys must not be null and table should be staged, as it is read twice. The order is by a hash bucket of
    the order columns and then by these, so that no task ever holds all rows of one key: within a bucket a window
    counts, and the buckets' totals (a few rows a key) give each bucket's offset.
    """
    rows = table.count() if rows is None else rows
    buckets = max(8, rows // 250_000)
    v = F.col(value).cast("long") if value else F.lit(1).cast("long")
    bucket = F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")
    by, sort = [f"k{i}" for i in range(len(keys))], [f"o{i}" for i in range(len(order))]
    # the row is one struct, so that its columns' names clash with none of these
    table = table.select(F.struct(*table.columns).alias("row"), v.alias("v"), bucket.alias("b"), *[F.col(k).alias(n) for k, n in zip(keys, by, strict=True)], *[F.col(c).alias(n) for c, n in zip(order, sort, strict=True)])
    totals = table.groupBy(*by, "b").agg(F.sum("v").alias("n"))
    before = Window.partitionBy(*by).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy(*by, "b").orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1)
    counted = table.withColumn("in", F.coalesce(F.sum("v").over(within), F.lit(0)))
    return counted.join(starts, [*by, "b"]).select("row.*", (F.col("start") + F.col("in")).alias(out))


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES, rows: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch of about `most` bytes of text and `rows` rows at most, each with its bytes and the offsets of its rows; null is empty."""
    texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = min(at + rows, max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1))
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
    give_back()


def spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in data, and each row's first word; words don't cross rows."""
    word = ~separator[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    gap = np.ones(len(data) + 1, bool)
    gap[1:] = ~word
    starts = np.flatnonzero(word & (gap[:-1] | first[:-1]))
    gap[:-1] = ~word
    gap[-1] = True
    ends = np.flatnonzero(word & (gap[1:] | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on arrays of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_FIRST_BYTES = np.array([0] + [(1 << 8 * n) - 1 for n in range(1, 9)], np.uint64)


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two hashes in this order."""
    return mix(a * np.uint64(0x9FB21C651E98DF25) + b)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes: eight bytes at a time, mixed with their place and added up, and mixed again with the length.

    Spans of one length of up to eight bytes never share a hash.
    """
    return _span_hashes(data, starts, ends, 1)[0]


def span_hash_pairs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """span_hashes() and a second hash of 64 bits that has nothing to do with the first: together they tell words apart."""
    one, two = _span_hashes(data, starts, ends, 2)
    return one, two


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, many: int) -> list[np.ndarray]:
    if not len(starts):
        return [np.zeros(0, np.uint64)] * many
    eights = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), 0, (1,))  # the eight bytes from each byte on
    length = (ends - starts).astype(np.int64)
    parts = np.maximum(1, (length + 7) >> 3)
    first = np.cumsum(parts) - parts
    k = np.arange(first[-1] + parts[-1]) - np.repeat(first, parts)
    at = np.repeat(starts, parts) + 8 * k
    x = eights[at] & _FIRST_BYTES[np.minimum(8, np.repeat(length, parts) - 8 * k)]
    place = (k + 1).astype(np.uint64) * _GOLDEN
    mixed = [mix(x + place), mix((x ^ np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xA0761D6478BD642F) + place)][:many]
    return [mix(np.add.reduceat(m, first) + length.astype(np.uint64)) for m in mixed]


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n words from each word on, given the words' hashes: windows of 1, 2, 4, ... words, and at the end
    the two of these that make up n words. Empty where there are fewer words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    wide, out = 1, mix(words + _GOLDEN)
    while 2 * wide <= n:
        out = joined(out[:-wide], out[wide:])
        wide *= 2
    return joined(out[: len(words) - n + 1], out[n - wide :])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return _LOWER[data]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start+1, ... of all ranges, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


class Memo:
    """A bounded map from words, told apart by two hashes of 64 bits, to short rows of numbers, as sorted arrays; it starts anew when full."""

    def __init__(self, kind: type, most: int = 1_500_000):
        self.kind, self.most = kind, most
        self.clear()

    def clear(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts, self.lengths, self.flat = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, self.kind)

    def make_room(self, n: int) -> None:
        if len(self.keys) + n > self.most:
            self.clear()

    def find(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word its index, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, (self.keys[at] == keys) & (self.checks[at] == checks)

    def add(self, keys: np.ndarray, checks: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> None:
        """keys: sorted. Of words with one first hash the first is kept."""
        starts = np.cumsum(lengths) - lengths + len(self.flat)
        at = np.searchsorted(self.keys, keys)
        new = np.r_[True, keys[1:] != keys[:-1]][: len(keys)]
        if len(self.keys):
            new &= self.keys[np.minimum(at, len(self.keys) - 1)] != keys
        at = at[new]
        self.keys, self.checks = np.insert(self.keys, at, keys[new]), np.insert(self.checks, at, checks[new])
        self.starts = np.insert(self.starts, at, starts[new].astype(np.int32))
        self.lengths = np.insert(self.lengths, at, lengths[new].astype(np.int32))
        self.flat = np.concatenate([self.flat, flat.astype(self.kind)])


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the spans: the distinct ones' two hashes, sorted, an example's index for each, and for each span the index of its own."""
    one, two = span_hash_pairs(data, starts, ends)
    keys, example, back = np.unique(one, return_index=True, return_inverse=True)
    if (two != two[example][back]).any():  # two words with one first hash
        pairs, example, back = np.unique(np.column_stack([one, two]), axis=0, return_index=True, return_inverse=True)
        keys, back = pairs[:, 0], back.ravel()
    return keys, two[example], example, back
