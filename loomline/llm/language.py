"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent n-grams (1 to 3 letters, within words, lower case), most frequent first. Letters are
those of any script, and marks; words are what is between other characters, and an n-gram may take in the blank before and after its word.
A document gets a list of its own; its distance to a language is the sum, over its n-grams, of how far each is out
of place in the profile, with the profile's length for those that are not in it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import bounded_batches, crc_bucket, text_slices

PROFILE = 300
UNKNOWN = "und"
#: Languages that can be learned: each has a profile of PROFILE n-grams on the driver and in every task. More raise an error.
MOST_LANGUAGES = 2000
#: Distinct n-grams that a counting task holds before it hands its sums on.
HELD_GRAMS = 2_000_000

#: For each character what it counts as: 0 not looked up yet, 32 for what is no letter or mark, else itself in lower case. Filled as characters occur.
_FOLDED = np.zeros(0x110000, np.uint32)


def _folded(text: str) -> np.ndarray:
    """The text's characters as numbers, as _FOLDED has them."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    folded = _FOLDED[points]
    if not folded.all():
        for x in np.unique(points[folded == 0]).tolist():
            small = chr(x).lower()
            _FOLDED[x] = 32 if unicodedata.category(chr(x))[0] not in "LM" else ord(small) if len(small) == 1 else x
        folded = _FOLDED[points]
    return folded


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All n-grams as numbers, the index of each one's first letter, and where each row begins, among characters with a blank before each row."""
    starts = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][offsets]  # rows, in characters
    folded = _folded(data.tobytes().decode("utf-8", "replace"))
    padded = np.full(len(folded) + len(starts) + 2, 32, np.int64)  # a blank before each row, and two at the end, so that every row has one after it
    padded[np.arange(len(folded)) + np.repeat(np.arange(1, len(starts)), np.diff(starts))] = folded
    a, b, c = padded[:-2], padded[1:-1], padded[2:]
    one = np.flatnonzero(b != 32)
    two = np.flatnonzero((a != 32) | (b != 32))
    grams = np.concatenate([b[one], (a[two] << 21) | b[two], (a[one] << 42) | (b[one] << 21) | c[one]])
    return grams, np.concatenate([one, two, one]), starts + np.arange(len(starts))


def _row_of(where: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The row that a gram at this index belongs to."""
    return np.searchsorted(rows, where, "right") - 1


def profiles(docs: DataFrame, length: int = PROFILE) -> dict[str, list[int]]:
    """The most frequent n-grams of each language over all rows of docs (text, lang; both not null), ties by n-gram.

    A task counts its part of the corpus, and hands its sums on whenever they have many n-grams; the counts are added up in Spark, and length rows a language
    come to the driver. More than MOST_LANGUAGES languages raise an error.
    """
    bounded_batches(docs.sparkSession)
    known = docs.select("text", F.col("lang").cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    if known.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (g, n) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n, pa.int64())], ["lang", "gram", "n"])
            sums.clear()

        for batch in batches:
            for part, data, offsets in text_slices(batch):
                if sum(len(g) for g, _ in sums.values()) > HELD_GRAMS:
                    yield from flush()
                grams, where, rows = _grams(data, offsets)
                langs = np.array(part.column("lang").to_pylist(), object)
                rows = _row_of(where, rows)
                for lang in set(langs):
                    g, n = np.unique(grams[(langs == lang)[np.minimum(rows, len(langs) - 1)]], return_counts=True)
                    if lang in sums:
                        g, back = np.unique(np.r_[sums[lang][0], g], return_inverse=True)
                        n = np.bincount(back, np.r_[sums[lang][1], n]).astype(np.int64)
                    sums[lang] = g, n
        yield from flush()

    counts = known.mapInArrow(count, "lang string, gram long, n long")
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    out: dict[str, list[int]] = {}
    for r in sorted(totals.withColumn("rank", rank).where(F.col("rank") <= length).collect(), key=lambda r: (r["lang"], r["rank"])):
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


def out_of_place(texts: tuple[np.ndarray, np.ndarray], langs: dict[str, list[int]], length: int = PROFILE) -> tuple[np.ndarray, np.ndarray]:
    """For each row its distance to each language and the greatest distance it could have."""
    data, offsets = texts
    known = np.unique(np.array([g for p in langs.values() for g in p], np.int64))
    ranks = np.full((len(known) + 1, len(langs)), length, np.int64)
    for j, p in enumerate(langs.values()):
        ranks[np.searchsorted(known, np.array(p, np.int64)), j] = np.arange(len(p))
    grams, where, rows = _grams(data, offsets)
    of_row = _row_of(where, rows)
    order = np.argsort(of_row, kind="stable")
    grams = grams[order]
    cuts = np.searchsorted(of_row[order], np.arange(len(offsets)))
    distance = np.zeros((len(offsets) - 1, len(langs)))
    most = np.zeros(len(offsets) - 1)
    for i in range(len(offsets) - 1):
        g, n = np.unique(grams[cuts[i] : cuts[i + 1]], return_counts=True)
        top = g[np.argsort(-n, kind="stable")[:length]]
        at = np.searchsorted(known, top)
        at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != top)] = len(known)
        place = ranks[at]
        distance[i] = np.where(place == length, length, np.abs(place - np.arange(len(top))[:, None])).sum(axis=0)
        most[i] = length * len(top)
    return distance, most


def identify(docs: DataFrame, langs: dict[str, list[int]], length: int = PROFILE) -> DataFrame:
    """doc_id, lang_pred, score of every row: the language at the least distance (ties: the first by code point), and one minus that distance's part of the greatest one.

    Null texts, texts without a letter, and all texts where no language was learned: `und` and 0.
    """

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(list(langs) or [UNKNOWN], object)
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                letters = np.array(part.column("letters").to_pylist(), bool)
                best, score = np.zeros(len(letters), int), np.zeros(len(letters))
                if langs and letters.any():
                    distance, most = out_of_place((data, offsets), langs, length)
                    best = distance.argmin(axis=1)
                    score = np.clip(1 - distance.min(axis=1) / np.maximum(most, 1), 0, 1) * (most > 0)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.where(letters, names[best], UNKNOWN), pa.string()), pa.array(np.where(letters, score, 0.0))], ["doc_id", "lang_pred", "score"])

    bounded_batches(docs.sparkSession)
    letters = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("letters")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", letters).mapInArrow(predict, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from rows with a language whose crc32(doc_id) modulo `modulus` is not `held`.

    A null doc_id counts as remainder 0. Repeated rows count as often as they come; an empty table gives an empty result.
    """
    bucket = crc_bucket(F.col("doc_id"), modulus)
    learned = profiles(docs.where(bucket != held))
    out = identify(docs, learned)
    return out.select("doc_id", (crc_bucket(F.col("doc_id"), modulus) == held).alias("held_out"), "lang_pred", "score")
