"""Slices of an Arrow array of texts, for work that turns texts into Python objects, which are many times as large."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: What one slice has at most; a longer text is a slice of its own.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 1000


def slices(texts: pa.Array, most: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[pa.Array]:
    """The array in parts of about `most` bytes and `rows` texts at most."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + most, "right"))))
        yield texts.slice(at, to - at)
        at = to


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches end at 8 MB, so that a batch of long texts is no larger than one of many."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
