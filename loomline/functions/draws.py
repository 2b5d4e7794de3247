"""Deterministic draws: each is a column of its own hash stream, so rows need no order and any task can make any row.

u is the first 32 bits of md5('seed|stream|id') over 2^32, the same in any engine that has md5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomline.sources.dimensions import DIFFICULTIES, TOOLS


def uniform(stream: str, seed: Column | int, row: Column) -> Column:
    seed = F.lit(seed) if isinstance(seed, int) else seed
    key = F.concat_ws("|", seed.cast("string"), F.lit(stream), row.cast("string"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def ladder(u: Column, steps: list[tuple[str, float]]) -> Column:
    """The first value whose running sum of weights exceeds u times their total; the last value catches rounding."""
    total = sum(w for _, w in steps)
    out, at = None, 0.0
    for value, weight in steps[:-1]:
        at += weight
        test = u < F.lit(at / total)
        out = F.when(test, value) if out is None else out.when(test, value)
    return F.lit(steps[-1][0]) if out is None else out.otherwise(steps[-1][0])


def tool(seed: Column | int, row: Column) -> Column:
    return ladder(uniform("tool", seed, row), [(t[0], t[2]) for t in TOOLS])


def difficulty(seed: Column | int, row: Column) -> Column:
    return ladder(uniform("difficulty", seed, row), DIFFICULTIES)


def pick(u: Column, n: Column | int) -> Column:
    """A number from 0 below n."""
    return F.floor(u * (F.lit(n) if isinstance(n, int) else n)).cast("int")


def success(seed: Column | int, row: Column, include_error: bool, rate: float = 0.15) -> Column:
    return (uniform("failure", seed, row) > F.lit(rate)) if include_error else F.lit(True)


def call_id(seed: Column | int, row: Column) -> Column:
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.concat(F.lit("call_"), F.substring(F.md5(F.concat_ws("|", seed.cast("string"), F.lit("id"), row.cast("string")).cast("binary")), 1, 12))
