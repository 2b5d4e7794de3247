"""N-gram Jaccard join by a token-group matrix.

Each document is the set of 64-bit hashes of its distinct word shingles; equal sets are one class from here on, named by a 64-bit hash
of the set, or where two sets have the same one by a hash that takes in 64 more bits. The join is exact (but for collisions of 64-bit
shingles and 128-bit sets):

1. A global order of tokens: rare ones first, by counts of all documents' tokens in a table of fixed size, then by hash.
   Two sets of similarity t or more share s tokens among the first |x| - ceil(t |x|) + s of each (the prefix filter);
   s grows with the set, so that passages or phrases that many texts have don't make them meet.
   Only classes near enough in size count. Classes with fewer prefix tokens in common with such others take no further part;
   the rest keep those of their common tokens that are rarest by exact counts over all these classes.
2. Classes with an equal min-hash (of KEYS different ones) meet in chunks of about CHUNK, where exact intersections are
   computed as a matrix product; links join them. No chunk grows with the data. A class's group is its chunk under
   the min-hash that most classes have, so that many alike fill few groups.
3. The token-group matrix holds each group's token union: distinct (prefix token, group). Joined with itself, it bounds what
   two groups have in common; of groups that reach the bound, joined with the classes of the one, how much of each class the other
   can hold. Only groups that reach this bound are opened, and tokens that a group has only from the class's own component don't count.
4. An opened group's members meet the classes that opened it, in blocks of at most CHUNK that tasks share out, again as a matrix
   product. Of a block's links only so many are written as lead from each class to the smallest that it is linked with, by whatever way.

Links within and between groups give the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm.common import BROADCAST_IDS, hot_keys, id_and_text, join_groups, lower_ascii, mix, span_hashes, spans, staged, text_slices, window_hashes, with_known_ids
from loomline.llm.graph import components

KEYS = 3
CHUNK = 256
BUCKET_BITS = 18
#: Times that classes with too few tokens in common go before the groups are made.
ROUNDS = 1
#: Of the tokens that two similar sets share for certain, so many must be among the rarest of each.
FEW = 3
#: Tokens that a matrix product of a chunk or group takes up at once, about.
AT_ONCE = 500_000
#: Sets that a task remembers before it starts anew.
SEEN = 500_000
_SALTS = [np.uint64(x) for x in (0x8BB84B93962EACC9, 0x4B33A62ED433D4A3, 0x4D5A2DA51DE1AA47, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct shingles; a text of fewer words is one shingle, one without words has none."""
    data = lower_ascii(data)
    starts, ends, first = spans(data, offsets)
    hashes = span_hashes(data, starts, ends)
    shingles = window_hashes(hashes, words)
    short = {n: window_hashes(hashes, n) for n in range(1, words)}
    return [np.unique(shingles[a : b - words + 1]) if b - a >= words else short[b - a][a : a + 1] if b > a else np.zeros(0, np.uint64) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def _set_keys(s: np.ndarray, bits: int = 64) -> tuple[int, int]:
    """Two hashes of a set; the first one has `bits` bits."""
    a, b = mix(s ^ _SALTS[0]), mix(s + _SALTS[1])
    one, two = mix(a.sum(keepdims=True) ^ b.sum(keepdims=True)), mix(mix(a + b).sum(keepdims=True) + np.uint64(len(s)))
    return int((one >> np.uint64(64 - bits)).view(np.int64)[0]), int(two.view(np.int64)[0])


def told_apart(rows: DataFrame, shared: DataFrame | None) -> DataFrame:
    """rows (cls, check) without check; classes in shared, whose first hash is that of several sets, are named by both hashes."""
    if shared is None:
        return rows.drop("check")
    rows = rows.join(F.broadcast(shared.select("cls", F.lit(True).alias("among"))), "cls", "left")
    return rows.withColumn("cls", F.when(F.col("among"), F.xxhash64("cls", "check")).otherwise(F.col("cls"))).drop("among", "check")


def needed(n: int, percent: int) -> int:
    """Tokens that a set of n shares at least with one of similarity percent / 100 or more."""
    return -(-percent * n // 100)


def overlap(n: int, percent: int) -> int:
    """s for a set of n: its prefix has n - needed + s tokens."""
    return min(needed(n, percent), 6 + n // 20)


def least_overlap(n: str, percent: int) -> str:
    """SQL for the least s of all sets that one of n may be similar to: so many prefix tokens two similar sets share."""
    least = f"(({percent} * {n} + 99) div 100)"
    return f"least(({percent} * {least} + 99) div 100, 6 + {least} div 20)"


def bucket_levels(docs: DataFrame, words: int) -> np.ndarray:
    """How common the tokens of each of 2^BUCKET_BITS buckets are, in powers of two above the median bucket; a table of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for _, data, offsets in text_slices(batch):
                for s in shingle_sets(data, offsets, words):
                    np.add.at(sums, (s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), 1)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], ["bucket", "n"])

    counts = docs.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(1 << BUCKET_BITS, np.int64)
    sums[counts.column("bucket").to_numpy()] = counts.column("n").to_numpy()
    usual = max(8.0, float(np.median(sums)))
    return np.maximum(0, np.floor(np.log2(np.maximum(sums, 1) / usual))).astype(np.uint8)


def prefixes(docs: DataFrame, words: int, percent: int, levels: np.ndarray, bits: int = 64) -> DataFrame:
    """doc_id, cls, check, n (the set's hashes and size), its prefix tokens in the global order, and fresh: false where the same task had a row of the same set shortly
    before, so that of a set that most rows have a few rows a task are fresh, and all sets have some."""
    sent = docs.sparkSession.sparkContext.broadcast(levels)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                keys, sizes, tokens, fresh = [], [], [], []
                for s in shingle_sets(data, offsets, words):
                    n = len(s)
                    order = (sent.value[(s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (mix(s ^ _SALTS[2]) >> np.uint64(8))
                    most = n - needed(n, percent) + overlap(n, percent)
                    keep = np.argpartition(order, most - 1)[:most] if n else np.zeros(0, np.int64)
                    keys.append(_set_keys(s, bits))
                    fresh.append(keys[-1] not in seen)
                    seen.add(keys[-1])
                    sizes.append(n)
                    tokens.append(s[keep].view(np.int64))
                flat = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(t) for t in tokens])].astype(np.int32)), pa.array(np.concatenate(tokens)))
                cls, check = np.array(keys, np.int64).reshape(-1, 2).T
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(cls), pa.array(check), pa.array(sizes, pa.int64()), flat, pa.array(fresh, pa.bool_())], ["doc_id", "cls", "check", "n", "prefix", "fresh"])
                if len(seen) > SEEN:
                    seen.clear()

    return docs.mapInArrow(cut, "doc_id long, cls long, check long, n long, prefix array<long>, fresh boolean")


def full_sets(docs: DataFrame, words: int, bits: int = 64) -> DataFrame:
    """cls, check, n, keys (KEYS min-hashes) and the whole set, as sorted unsigned 64-bit numbers, of each row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_slices(batch):
                rows = [(*_set_keys(s, bits), len(s), [int(mix(s ^ salt).min().astype(np.int64)) for salt in (_SALTS[2] + np.uint64(1), _SALTS[3], _SALTS[4])], s.tobytes()) for s in shingle_sets(data, offsets, words) if len(s)]
                if rows:
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()), strict=True)], ["cls", "check", "n", "keys", "tokens"])

    return docs.mapInArrow(make, "cls long, check long, n long, keys array<long>, tokens binary")


def token_ranges(sets: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The sets' tokens range by range, about AT_ONCE a time: as hashes they spread evenly over the ranges."""
    n = -(-sum(map(len, sets)) // AT_ONCE)
    cuts = np.array([(i << 64) // n for i in range(1, n)], np.uint64)
    at = [np.r_[0, np.searchsorted(s, cuts), len(s)] for s in sets]
    for i in range(n):
        yield [s[x[i] : x[i + 1]] for s, x in zip(sets, at, strict=True)]


def _add_common(both: np.ndarray, sets: list[np.ndarray]) -> None:
    """Add the sizes of the sets' intersections to both."""
    token, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, often = np.unique(token, return_inverse=True, return_counts=True)
    shared = often[column] > 1
    place = np.cumsum(often > 1) - 1
    owner, column, width = owner[shared], place[column[shared]], int((often > 1).sum())
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for lo in range(0, width, 8192):
        a, b = np.searchsorted(column, [lo, lo + 8192])
        block = np.zeros((len(sets), min(8192, width - lo)), np.float32)
        block[owner[a:b], column[a:b] - lo] = 1
        both += (block @ block.T).astype(np.int64)


def link_chunk(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links among a few sets, as (index, smallest index of its component)."""
    sizes = np.array([len(s) for s in sets])
    both = np.zeros((len(sets), len(sets)), np.int64)
    for part in token_ranges(sets):
        _add_common(both, part)
    both[np.diag_indices(len(sets))] = sizes
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    root = np.arange(len(sets))
    while True:
        least = np.where(linked, root[None, :], len(sets)).min(axis=1)
        least = np.minimum(root, least)
        least = least[least]
        if (least == root).all():
            return [(i, int(r)) for i, r in enumerate(root) if i != r]
        root = least


def _add_met(both: np.ndarray, queries: list[np.ndarray], members: list[np.ndarray]) -> None:
    """Add the sizes of the intersections of queries (rows) and members (columns) to both."""
    token, owner = np.concatenate(members), np.repeat(np.arange(len(members)), [len(m) for m in members])
    asked, asker = np.concatenate(queries), np.repeat(np.arange(len(queries)), [len(q) for q in queries])
    known, column = np.unique(token, return_inverse=True)
    if not len(known):
        return
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    hit = known[at] == asked
    used, place = np.unique(at[hit], return_inverse=True)
    if not len(used):
        return
    asker = asker[hit]
    of = np.searchsorted(used, column)
    inside = (of < len(used)) & (used[np.minimum(of, len(used) - 1)] == column)
    owner, of = owner[inside], of[inside]
    for lo in range(0, len(used), 8192):
        width = min(8192, len(used) - lo)
        x, y = np.zeros((len(queries), width), np.float32), np.zeros((len(members), width), np.float32)
        here, there = (place >= lo) & (place < lo + width), (of >= lo) & (of < lo + width)
        x[asker[here], place[here] - lo] = 1
        y[owner[there], of[there] - lo] = 1
        both += (x @ y.T).astype(np.int64)


def link_blocks(queries: list[np.ndarray], members: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Of queries and members, numbered one after the other: (number, smallest number that links lead to) for each that has a link and isn't that
    number itself. So many rows at most as there are sets, however many of them link."""
    q = len(queries)
    both = np.zeros((q, len(members)), np.int64)
    for part in token_ranges(queries + members):
        _add_met(both, part[:q], part[q:])
    sizes = np.array([len(x) for x in queries])[:, None] + np.array([len(m) for m in members])[None, :]
    linked = 100 * both >= percent * (sizes - both)
    last = q + len(members)
    roots, own = np.arange(q), np.arange(q, last)
    while linked.any():
        of_member = np.minimum(own, np.where(linked, roots[:, None], last).min(axis=0))
        of_query = np.minimum(roots, np.where(linked, of_member[None, :], last).min(axis=1))
        if (of_member == own).all() and (of_query == roots).all():
            break
        roots, own = of_query, of_member
    return [(i, int(r)) for i, r in enumerate(np.r_[roots, own]) if i != r]


def chunks_of(sets: DataFrame) -> DataFrame:
    """cls, chunks (which, mark, chunk): where a class meets others with an equal min-hash; grp, the chunk of the most common one."""
    keyed = sets.select("cls", F.posexplode("keys").alias("which", "mark"))
    sizes = staged(keyed.groupBy("which", "mark").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "marks")
    chunk = F.pmod(F.xxhash64("cls", "which"), F.ceil(F.col("size") / CHUNK)).cast("int").alias("chunk")
    largest = F.max(F.struct("size", "which", "mark", chunk)).alias("largest")
    hot = hot_keys(sizes, ["which", "mark"], sizes.agg(F.sum("size")).first()[0] or 0, "size")
    met = join_groups(keyed, sizes, ["which", "mark"], hot, ["cls"]).groupBy("cls").agg(F.collect_list(F.struct("which", "mark", chunk)).alias("chunks"), largest)  # KEYS a class at most
    return met.select("cls", "chunks", F.xxhash64("largest.which", "largest.mark", "largest.chunk").alias("grp"))


def group_links(sets: DataFrame, plan: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes that share a min-hash and met in a chunk."""
    dealt = sets.select("cls", "tokens").join(plan.select("cls", "chunks"), "cls").select("cls", "tokens", F.inline("chunks"))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []
        last = None

        def close() -> Iterator[pa.RecordBatch]:
            # chunks are filled by hash, so they hold about CHUNK sets each
            if len(held) > 1 and (found := link_chunk([s for _, s in held], percent)):
                yield pa.RecordBatch.from_arrays([pa.array([held[i][0] for i, _ in found], pa.int64()), pa.array([held[r][0] for _, r in found], pa.int64())], ["a", "b"])

        for batch in batches:
            for key, cls, tokens in zip(zip(*(batch.column(c).to_pylist() for c in ("which", "mark", "chunk")), strict=True), batch.column("cls").to_pylist(), batch.column("tokens"), strict=True):
                if key != last:
                    yield from close()
                    held, last = [], key
                held.append((cls, np.frombuffer(tokens.as_py(), np.uint64)))
        yield from close()

    return dealt.repartition("which", "mark", "chunk").sortWithinPartitions("which", "mark", "chunk", "cls").mapInArrow(links, "a long, b long")


def opened_links(opened: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes (cls, other: the group to open) and the groups' members (cls, grp), by exact intersection."""
    # so many blocks of askers has each group; its members, CHUNK or so, go to all of them
    blocks = staged(opened.groupBy(F.col("other").alias("grp")).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("asks")), "blocks")
    hot = hot_keys(blocks, ["grp"], blocks.agg(F.sum("asks")).first()[0] or 0, "asks")
    asked = join_groups(opened.withColumnRenamed("other", "grp"), blocks, ["grp"], hot, ["cls"]).select("cls", "grp", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int").alias("block"))
    asked = asked.join(sets, "cls").select("grp", "block", F.lit(1).alias("part"), "cls", "tokens")
    held = members.join(blocks, "grp").select("cls", "grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    held = held.join(sets, "cls").select("grp", "block", F.lit(0).alias("part"), "cls", "tokens")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own, asking = None, [], []

        def meet() -> Iterator[pa.RecordBatch]:
            if own and asking and (found := link_blocks([s for _, s in asking], [s for _, s in own], percent)):
                names = [cls for cls, _ in asking + own]
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i, _ in found], pa.int64()), pa.array([names[r] for _, r in found], pa.int64())], ["a", "b"])

        for batch in batches:
            for grp, part, cls, tokens in zip(zip(batch.column("grp").to_pylist(), batch.column("block").to_pylist(), strict=True), batch.column("part").to_pylist(), batch.column("cls").to_pylist(), batch.column("tokens"), strict=True):
                if grp != group or len(asking) == CHUNK:
                    yield from meet()
                    asking = []
                    if grp != group:
                        group, own = grp, []
                (asking if part else own).append((cls, np.frombuffer(tokens.as_py(), np.uint64)))
        yield from meet()

    return held.unionByName(asked).repartition("grp", "block").sortWithinPartitions("grp", "block", "part", "cls").mapInArrow(links, "a long, b long")


def shared_tokens(rows: DataFrame, percent: int) -> DataFrame:
    """Of rows (cls, n, token), each distinct cls and token once, where another class that has the token is near enough in size to be similar.

    One range sort by (token, n, cls) brings a token's classes side by side, so the nearest in size is a neighbour; a token of
    very many classes goes on through several tasks. At the ends of batches a few rows more stay.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the last row of the batch before
        for batch in batches:
            if not batch.num_rows:
                continue
            token, n, cls = (batch.column(c).to_numpy() for c in ("token", "n", "cls"))
            new = np.r_[before is None or before[0] != token[0] or before[2] != cls[0], (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])]
            known = before or (token[0], n[0], cls[0])
            before = (token[-1], n[-1], cls[-1])
            token, n, cls = token[new], n[new], cls[new]
            if not len(token):
                continue
            near = (token[1:] == token[:-1]) & (100 * n[:-1] >= percent * n[1:])
            # the first row's neighbour is known unless it is with another task, the last one's never
            live = np.r_[known[0] == token[0] and 100 * known[1] >= percent * n[0], near] | np.r_[near, True]
            yield pa.RecordBatch.from_arrays([pa.array(cls[live]), pa.array(n[live]), pa.array(token[live])], ["cls", "n", "token"])

    return rows.select("cls", "n", "token").repartitionByRange("token", "n", "cls").sortWithinPartitions("token", "n", "cls").mapInArrow(keep, "cls long, n long, token long")


def with_enough(met: DataFrame, percent: int) -> DataFrame:
    """cls, n, tokens of the classes that have as many tokens in common with others as with a similar one, at the least."""
    held = met.groupBy("cls").agg(F.first("n").alias("n"), F.collect_list("token").alias("tokens"))  # a class's own prefix
    return held.where(F.expr(f"size(tokens) >= {least_overlap('n', percent)}"))


def few(n: str, percent: int) -> str:
    """SQL for how many of the rarest common tokens a set of n must share with a group to open it."""
    return f"least({FEW}, {least_overlap(n, percent)})"


def rarest(held: DataFrame, percent: int) -> DataFrame:
    """cls, n, tokens with each class's rarest tokens only, by exact counts over all classes held.

    Of c tokens in common with others a class shares at least s with a similar one. In any order of tokens that is the same for both,
    the first few of these shared ones are among the first c - s + few of either; the most common tokens go.
    """
    each = held.select("cls", "n", F.explode("tokens").alias("token"))
    counts = each.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    counts = staged(counts, "token-counts")
    hot = hot_keys(counts, ["token"], counts.agg(F.sum("df")).first()[0] or 0, "df")
    ordered = join_groups(each, counts, ["token"], hot, ["cls"]).groupBy("cls").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "token")))["token"].alias("tokens"))
    return ordered.withColumn("tokens", F.slice("tokens", F.lit(1), F.expr(f"cast(size(tokens) - {least_overlap('n', percent)} + {few('n', percent)} AS int)")))


def with_class(docs: DataFrame, words: int, bits: int = 64) -> DataFrame:
    """cls and check, the hashes of each row's set, beside the row as one struct, doc."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                cls, check = np.array([_set_keys(s, bits) for s in shingle_sets(data, offsets, words)], np.int64).reshape(-1, 2).T
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(cls), pa.array(check)], ["doc", "cls", "check"])

    rows = docs.select(F.struct(*docs.columns).alias("doc"), "text")
    return rows.mapInArrow(add, T.StructType([rows.schema["doc"], T.StructField("cls", T.LongType()), T.StructField("check", T.LongType())]))


def similar_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for every row: documents link when 100 * intersection >= percent * union of their shingle sets.

    Texts are lower-cased in A-Z. Null texts and texts without words have no shingles and link with nothing: component_id is their
    doc_id. A row with a null doc_id belongs to the component of the rows with the same set, or has null. Repeated rows
    come out as often as they came in; an empty table gives an empty result.
    """
    return class_components(docs, words, percent)[0].select("doc_id", "n_shingles", "component_id")


def class_components(docs: DataFrame, words: int, percent: int, bits: int = 64) -> tuple[DataFrame, DataFrame | None]:
    """similar_components(), with the class of each row's set, cls, and one class of its component for all rows of it, root; and
    the first hashes that several sets have, if any. bits: of the first hash (fewer in tests, so that sets share one)."""
    base = id_and_text(docs)
    table = staged(prefixes(base, words, percent, bucket_levels(base, words), bits), "prefixes")
    of_class = [F.first("n").alias("n"), F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("docs")]
    classes = staged(table.where("n > 0").groupBy("cls").agg(*of_class, (F.min("check") != F.max("check")).alias("several")), "classes")
    shared = None
    if not classes.where("several").isEmpty():
        shared = staged(classes.where("several").select("cls"), "classes-of-several-sets")
        table = staged(told_apart(table, shared), "prefixes")
        classes = staged(table.where("n > 0").groupBy("cls").agg(*of_class), "classes")
    met = staged(shared_tokens(table.where("n > 0 AND fresh").select("cls", "n", F.explode("prefix").alias("token")), percent), "met")
    # classes that go take their tokens along, which leaves others with too few
    for _ in range(ROUNDS):
        held = staged(with_enough(met, percent), "held")
        met = staged(shared_tokens(held.select("cls", "n", F.explode("tokens").alias("token")), percent), "met")
    held = staged(with_enough(met, percent), "held")
    live = staged(rarest(held, percent).join(classes.select("cls", "first_doc").where("first_doc IS NOT NULL"), "cls"), "live")

    ids = staged(live.select(F.col("first_doc").alias("doc_id")).distinct(), "live-ids")
    sets = told_apart(full_sets(with_known_ids(base, ids, ids.count()).select("doc_id", "text"), words, bits), shared)
    sets = sets.join(live.select("cls"), "cls", "left_semi").groupBy("cls").agg(*[F.first(c).alias(c) for c in ("n", "keys", "tokens")])
    sets = staged(sets, "sets")

    plan = staged(chunks_of(sets), "chunks")
    linked = staged(components(staged(group_links(sets, plan, percent), "links")), "linked")
    groups = live.select("cls", "n").join(plan.select("cls", "grp"), "cls", "left")
    groups = groups.join(linked.select(F.col("node").alias("cls"), "root"), "cls", "left").select("cls", "n", F.coalesce("grp", "cls").alias("grp"), F.coalesce("root", "cls").alias("comp"))
    groups = staged(groups, "groups")
    # sizes of similar sets are in one band or in neighbouring ones
    band = F.floor(F.log(F.col("n").cast("double")) / (log(100 / percent) + 1e-9)).cast("int")
    least = F.expr(few(f"(({percent} * n + 99) div 100)", percent))  # tokens that a class must share with a group
    grouped = staged(live.select("cls", F.explode("tokens").alias("token")).join(groups, "cls").withColumn("band", band).withColumn("least", least), "grouped")
    matrix = staged(grouped.groupBy("token", "band", "grp").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("least").alias("least")), "matrix")
    others = matrix.select("token", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"), F.col("grp").alias("other"), F.col("low").alias("other_low"), F.col("high").alias("other_high"))
    met = staged(matrix.join(others, ["token", "band"]).where("other < grp AND NOT (low = high AND low = other_low AND low = other_high)"), "met-groups")
    enough = met.groupBy("grp", "other").agg(F.count_distinct("token").alias("c"), F.min("least").alias("least")).where("c >= least").select("grp", "other")
    met = met.join(enough, ["grp", "other"], "left_semi").select("grp", "token", "band", "other", "other_low", "other_high")
    met = grouped.join(met, ["grp", "token", "band"]).where("NOT (other_low = other_high AND other_low = comp)")
    opened = staged(met.groupBy("cls", "least", "other").agg(F.count_distinct("token").alias("c")).where("c >= least").select("cls", "other"), "opened")
    between = opened_links(opened, groups.select("cls", "grp"), sets.select("cls", "tokens"), percent)
    links = between.unionByName(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))

    roots = components(links)
    joined = roots.select(F.col("node").alias("cls"), "root").unionByName(roots.select(F.col("root").alias("cls"), "root").distinct())
    joined = staged(joined.join(classes.select("cls", "first_doc"), "cls"), "joined")
    least = staged(joined.groupBy("root").agg(F.min("first_doc").alias("component"), F.count(F.lit(1)).alias("members")), "least")
    hot = hot_keys(least, ["root"], least.agg(F.sum("members")).first()[0] or 0, "members")
    named = staged(join_groups(joined, least, ["root"], hot, ["cls"]).select("cls", "component", "root"), "named")
    final = staged(classes.select("cls", "first_doc").join(named, "cls", "left").select("cls", F.coalesce("component", "first_doc").alias("component_id"), F.coalesce("root", "cls").alias("root")), "components")
    hot = hot_keys(classes, ["cls"], classes.agg(F.sum("docs")).first()[0] or 0, "docs")
    out = join_groups(table.select("doc_id", "cls", "n"), final, ["cls"], hot, ["doc_id"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "cls", "root")
    return out, shared


def one_per_component(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component of similar_components(): that with its smallest doc_id. All columns stay.

    Rows without words link with nothing and stay, as do rows with a null doc_id, which no id can name. Where an id repeats, each of its
    rows is told by its set as well; of rows with one id and one set one stays.
    """
    found, shared = class_components(docs, words, percent)
    found = staged(found, "similar")
    gone = staged(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    out = docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, "doc_id", "left_anti").select(*docs.columns)
    again = staged(found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id"), "ids-that-repeat")
    if again.isEmpty():
        return out
    told = found.join(again, "doc_id", "left_semi")
    stay = told.where("n_shingles > 0 AND doc_id = component_id").groupBy("doc_id", "root").agg(F.min("cls").alias("cls")).select("doc_id", "cls")
    stay = stay.unionByName(told.where("n_shingles = 0").select("doc_id", "cls")).distinct()
    rows = told_apart(with_class(docs.join(again, "doc_id", "left_semi").select(*docs.columns), words), shared)
    rows = rows.select("doc", "cls", F.col("doc.doc_id").cast("long").alias("doc_id"))
    one = rows.join(stay, ["doc_id", "cls"], "left_semi").dropDuplicates(["doc_id", "cls"])
    return out.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(one.select("doc.*"))
