"""Quality by nearest-neighbour voting in a latent-semantic space.

Texts are vectors of hashed byte trigrams (square roots of counts, length one) and of the share of words that repeat the
word before, so that a text of stuttered words has a direction of its own. Labelled rows, up to SAMPLE of each label,
chosen by a hash of their id, are brought to the driver as vectors, and their leading singular directions span the latent
space. The labelled vectors in that space, a few MB whatever the corpus, are sent to all tasks, where every document meets all of them in
blocks of exact cosine products; its nearest ones vote, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm.common import bounded_batches, crc_bucket, id_and_text, span_hashes, spans, text_slices, unused

#: Labelled rows of either label that the model is fitted on, at most.
SAMPLE = 1500
BINS = 4096
WIDTH = BINS + 1
RANK = 64
NEIGHBOURS = 15
SHARPNESS = 8
#: Texts whose vectors one numpy pass makes, about 50 kB each; without it, batches of short texts would need much more.
ROWS = 128


def trigram_vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row for each text: BINS square roots of counts, of length one (none for under 3 bytes), and the square root of the share of repeated words."""
    rows = len(offsets) - 1
    if len(data) < 3:
        return np.zeros((rows, WIDTH), np.float32)
    x = data.astype(np.uint32)
    code = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
    bins = (code * np.uint32(2654435761)) >> np.uint32(20)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    same = row[:-2] == row[2:]
    counts = np.bincount(row[:-2][same] * BINS + bins[same], minlength=rows * BINS).reshape(rows, BINS)
    out = np.sqrt(counts, dtype=np.float32)
    starts, ends, first = spans(data, offsets)
    words = span_hashes(data, starts, ends)
    same = np.r_[False, words[1:] == words[:-1]][: len(words)]
    same[first[:-1][np.diff(first) > 0]] = False  # a row's first word has none before it
    again = np.r_[0, np.cumsum(same)]
    share = (again[first[1:]] - again[first[:-1]]) / np.maximum(np.diff(first), 1)
    return np.column_stack([out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9), np.sqrt(share, dtype=np.float32)]).astype(np.float32)


@dataclass
class Voters:
    mean: np.ndarray
    basis: np.ndarray  # WIDTH x rank
    vectors: np.ndarray  # labelled rows x rank, of length one
    labels: np.ndarray
    weights: np.ndarray  # of each labelled row: how many rows of its label it stands for

    def score(self, texts: np.ndarray) -> np.ndarray:
        """The weighted vote of each text's nearest labelled vectors (of equally near ones those of the smallest ids); a text without direction gets the labels' mean."""
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        x = (texts - self.mean) @ self.basis
        cosine = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = _nearest(cosine, k)
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-6).astype(float) ** SHARPNESS * self.weights[near]
        return np.clip((weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1), 0, 1)


def _nearest(cosine: np.ndarray, k: int) -> np.ndarray:
    """The places of the k greatest of each row; of equal ones at the end the first, as the voters go by doc_id."""
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    last = np.take_along_axis(cosine, near, axis=1).min(axis=1)
    for i in np.flatnonzero((cosine >= last[:, None]).sum(axis=1) > k):
        over, equal = np.flatnonzero(cosine[i] > last[i]), np.flatnonzero(cosine[i] == last[i])
        near[i] = np.r_[over, equal[: k - len(over)]]
    return near


def fit(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE, rank: int = RANK) -> Voters:
    """Fit on labelled (doc_id, label in 0..1, one row an id): up to `sample` rows of labels below and from 0.5 on."""
    chosen = None
    totals = labelled.agg(F.count_if(F.col("label") < 0.5).alias("low"), F.count_if(F.col("label") >= 0.5).alias("high")).first()
    for part in (labelled.where("label < 0.5"), labelled.where("label >= 0.5")):
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, rows=ROWS):
                x = trigram_vectors(data, offsets).astype(np.float16)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array([v.tobytes() for v in x], pa.binary())], ["doc_id", "label", "v"])

    rows = id_and_text(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text").mapInArrow(vectors, "doc_id long, label double, v binary")
    # where an id repeats, one of its texts
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("label", "v")).alias("x")).select("doc_id", "x.*").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["v"])))
    labels = np.array([r["label"] for r in rows], float)
    x = np.frombuffer(b"".join(bytes(r["v"]) for r in rows), np.float16).reshape(-1, WIDTH).astype(np.float32)
    if not len(rows):
        return Voters(np.zeros(WIDTH, np.float32), np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), labels, labels)
    high = labels >= 0.5
    weights = np.where(high, totals["high"] / max(1, high.sum()), totals["low"] / max(1, (~high).sum()))
    mean = x.mean(axis=0)
    x = x - mean
    # leading right singular vectors, by subspace iteration from a fixed start
    basis = np.random.default_rng(0).standard_normal((WIDTH, min(rank, len(rows)))).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    latent = x @ basis
    return Voters(mean, basis, (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)).astype(np.float32), labels, weights)


def score(docs: DataFrame, voters: Voters, keep: list[str], name: str = "score") -> DataFrame:
    """The columns `keep` of docs, and the vote for label 1 under `name`."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(voters)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, rows=ROWS):
                yield part.select(keep).append_column(name, pa.array(sent.value.score(trigram_vectors(data, offsets))))

    return docs.mapInArrow(vote, T.StructType([*(docs.schema[c] for c in keep), T.StructField(name, T.DoubleType())]))


def labels_by_id(labels: DataFrame, column: str = "quality") -> DataFrame:
    """doc_id, label: the mean where an id has several; null ids and labels go."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("double").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.avg("label").alias("label"))


def classify(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from labelled rows whose crc32(doc_id) modulo `modulus` is not `held`.

    score is the vote for label 1; predicted is 1 from 0.5 on. Null and empty texts are scored like others. Without
    any labelled row every score is 0.5. Repeated rows are scored as often as they come; an empty table gives an empty result.
    """
    voters = fit(docs, labels_by_id(labels).where(crc_bucket(F.col("doc_id"), modulus) != held))
    scored = score(id_and_text(docs), voters, ["doc_id"])
    return scored.select("doc_id", (crc_bucket(F.col("doc_id"), modulus) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1) -> DataFrame:
    """The rows of docs, with all their columns, that classify() predicts to be of label 1; none of an empty table."""
    voters = fit(docs, labels_by_id(labels).where(crc_bucket(F.col("doc_id"), modulus) != held))
    vote = unused(docs.columns, "vote")
    return score(docs, voters, docs.columns, vote).where(F.col(vote) >= 0.5).drop(vote)
