"""Chat formatting in budgeted windows.

Prefix sums of the turns' tokens choose turn-aligned spans: a window takes new turns as long as they fit beside the conversation's system turn, which
every window retains, and the last few turns before them, a limited history. Each turn is new in one window; only there do an assistant's
words count for the loss, so that repeated targets are masked. Control strings inside texts are escaped reversibly, and what was formatted
can be read back from the output alone.

A conversation of over LONG bytes is cut into sections by its prefix sums, which tasks share out; a section begins a window, and gets the
system turn and the history before it along.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.common import BROADCAST_IDS, SLICE_BYTES, bounded_batches, staged
from loomline.llm.tokens import _piece_counts, whole_tokens
from loomline.operators.fold import running

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that mark turns here or in other templates (fixed values); none is left in a text.
CONTROL = [START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
ESCAPE = "␛"
_BROKEN = re.compile("|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in CONTROL))
_ESCAPED = re.compile(f"{ESCAPE}(.)", re.DOTALL)
_TURN = re.compile(f"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}\n", re.DOTALL)

#: Tokens of a window, of the history that it repeats at most, and of a section of a long conversation, about.
BUDGET, HISTORY, SECTION = 2048, 512, 64 * 2048
#: Bytes from which on a conversation is shared out in sections.
LONG = 4 << 20

WINDOWS = "conv_id long, section long, window int, n_context int, n_turns int, tokens long, over_budget boolean, formatted string, loss array<struct<start: int, end: int>>"


def escaped(text: str) -> str:
    """The text with the escape mark doubled and one after the first character of each control string."""
    return _BROKEN.sub(ESCAPE, text.replace(ESCAPE, ESCAPE * 2))


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escaped_role(role: str) -> str:
    """A role on one line."""
    return escaped(role).replace("\n", f"{ESCAPE}n")


def unescaped_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def formatted_turn(role: str, text: str) -> str:
    return f"{START}{escaped_role(role)}\n{escaped(text)}{END}\n"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts of a formatted window."""
    return [(unescaped_role(role), unescaped(text)) for role, text in _TURN.findall(formatted)]


def spans(tokens: list[int], system: int | None, inside: bool, start: int, budget: int, history: int) -> Iterator[tuple[bool, int, int, int]]:
    """Windows over turns of so many tokens, from turn `start` on: whether the system turn is retained, the first turn of the history, the first new turn, the one
    after the last.

    system: the system turn's tokens, if the conversation has one; inside: it is the first of tokens itself, and stands outside of them otherwise.
    A turn that doesn't fit is a window without history, and without the system turn if these two don't fit.
    """
    ends = [0]
    for n in tokens:
        ends.append(ends[-1] + n)
    own = 1 if system is not None and inside else 0
    i = start
    while i < len(tokens):
        kept = system is not None and not (own and i == 0) and system + tokens[i] <= budget and 2 * system <= budget
        room = budget - (system if kept else 0)
        least = max(own, bisect_left(ends, ends[i] - max(0, min(history, room - tokens[i])))) if i else 0
        h = min(i, least)
        j = max(i + 1, bisect_right(ends, ends[h] + room) - 1)
        yield kept, h, i, j
        i = j


def counted_turns(turns: DataFrame, model_path: str) -> DataFrame:
    """conv_id, turn, role, text and tokens, of each turn as it is formatted; null roles and texts are empty."""
    whole = whole_tokens(model_path)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [formatted_turn(r, t).encode() for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)]
            offsets = np.r_[0, np.cumsum([len(b) for b in blocks])].astype(np.int64)
            n, at = [np.zeros(0, np.int64)], 0
            while at < len(blocks):  # about SLICE_BYTES at a time
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
                n.append(_piece_counts(np.frombuffer(b"".join(blocks[at:to]), np.uint8), offsets[at : to + 1] - offsets[at], model_path, whole))
                at = to
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(n))], [*batch.schema.names, "tokens"])

    return rows.mapInArrow(count, "conv_id long, turn long, role string, text string, tokens long")


def _sections(long: DataFrame, history: int, section: int) -> DataFrame:
    """Turns of long conversations dealt to sections: conv_id, section, kind (0: the system turn, 1: history, 2: new), place, turn, role, text, tokens."""
    rows = running(long, ["conv_id"], ["turn", "role", "text"], sums={"place": F.lit(1), "until": F.col("tokens")}).withColumn("from", F.col("until") - F.col("tokens"))
    rows = rows.withColumn("section", F.expr(f"`from` div {section}"))
    columns = ["conv_id", "section", "kind", "place", "turn", "role", "text", "tokens"]
    new = rows.withColumn("kind", F.lit(2))
    system = (F.col("place") == 1) & (F.col("role") == "system")
    before = rows.where(~system & (F.col("from") >= (F.col("section") + 1) * section - history)).withColumn("section", F.col("section") + 1).withColumn("kind", F.lit(1))
    last = rows.groupBy("conv_id").agg(F.max("section").alias("last"))
    head = rows.where(system).join(last, "conv_id").where("last > 0").withColumn("section", F.explode(F.sequence(F.lit(1).cast("long"), "last"))).withColumn("kind", F.lit(0))
    return new.select(*columns).unionByName(before.select(*columns)).unionByName(head.select(*columns))


def _windows(dealt: DataFrame, budget: int, history: int) -> DataFrame:
    """The windows (WINDOWS) of sections that tasks hold sorted, one after the other."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal out, size
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32()}))]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], [f.split()[0] for f in WINDOWS.split(", ")][:8] + ["loss"])
            out, size = [], 0
            return batch

        def close(key: tuple, held: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal size
            new = [x for x in held if x[0] == 2]
            if not new:  # history of a section that a long turn has swallowed
                return
            past = [x for x in held if x[0] == 1]
            inside = key[1] == 0
            first = [x for x in held if x[0] == 0] or (new[:1] if inside and new[0][1] == "system" else [])
            turns = past + new
            blocks = [formatted_turn(x[1], x[2]) for x in turns]
            for window, (kept, h, i, j) in enumerate(spans([x[3] for x in turns], first[0][3] if first else None, inside, len(past), budget, history)):
                parts = ([formatted_turn(first[0][1], first[0][2])] if kept else []) + blocks[h:j]
                at, loss = sum(map(len, parts[: len(parts) - (j - i)])), []
                for (_, role, _, _), block in zip(turns[i:j], blocks[i:j], strict=True):
                    if role == "assistant":
                        begin = at + block.index("\n") + 1
                        loss.append({"start": begin, "end": at + len(block) - len(END) - 1})
                    at += len(block)
                n = sum(x[3] for x in turns[h:j]) + (first[0][3] if kept else 0)
                text = "".join(parts)
                out.append((*key, window, len(parts) - (j - i), len(parts), n, n > budget, text, loss))
                size += len(text)
                if size > 2 << 20:
                    yield flush()

        key, held = None, []
        for batch in batches:
            rows = [batch.column(c).to_pylist() for c in ("conv_id", "section", "kind", "role", "text", "tokens")]
            for conv, section, *rest in zip(*rows, strict=True):
                if key != (conv, section):
                    if held:
                        yield from close(key, held)
                    key, held = (conv, section), []
                held.append(tuple(rest))
        if held:
            yield from close(key, held)
        if out:
            yield flush()

    return dealt.mapInArrow(make, WINDOWS)


def window_parts(turns: DataFrame, model_path: str, budget: int = BUDGET, history: int = HISTORY, section: int = SECTION, long: int = LONG) -> tuple[DataFrame, DataFrame]:
    """The windows of conversations up to `long` bytes, each conversation's in order in one task, and those of longer ones, in any order. See chat_windows()."""
    bounded_batches(turns.sparkSession)
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long") + 64
    large = staged(turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sum(size).alias("n")).where(F.col("n") > long).select(F.struct("conv_id").alias("key")), "long-conversations")
    n = large.count()
    counted = counted_turns(turns, model_path)
    usual = counted
    if n:
        large = F.broadcast(large) if n <= BROADCAST_IDS else large
        keyed = counted.withColumn("key", F.struct("conv_id"))  # in a struct null is equal to null
        usual = keyed.join(large, "key", "left_anti").drop("key")
    whole = usual.select("conv_id", F.lit(0).cast("long").alias("section"), F.lit(2).alias("kind"), "turn", "role", "text", "tokens")
    short = _windows(whole.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"), budget, history)
    if not n:
        return short, short.limit(0)
    cut = _sections(keyed.join(large, "key", "left_semi").drop("key"), history, max(section, 2 * history, 2 * budget))
    return short, _windows(cut.repartition("conv_id", "section").sortWithinPartitions("conv_id", "section", "kind", "place"), budget, history)


def chat_windows(turns: DataFrame, model_path: str, budget: int = BUDGET, history: int = HISTORY, section: int = SECTION, long: int = LONG) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as formatted windows of at most `budget` tokens (WINDOWS): n_context repeated turns, then new ones; loss: the spans of code points of new
    assistant texts.

    Turns go by turn, then role and text, so that ties and repeated rows have a place of their own; null turns come first, null roles and texts are empty, and
    rows without a conv_id are one conversation. Tokens are those of each formatted turn by itself. A turn of more than `budget` tokens is a
    window of its own (over_budget): nothing is cut. Other columns aren't looked at; an empty table gives an empty result. A turn is held whole by its
    task, some 40 times its bytes while tokens are counted, so texts of over some 50 MB don't fit executors of 3 GB.
    """
    short, cut = window_parts(turns, model_path, budget, history, section, long)
    return short.unionByName(cut)


def digests(windows: DataFrame) -> DataFrame:
    """What a conversation's windows (sorted in their tasks) hold, read back from the formatted texts and the loss spans: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, n_windows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

        def row(conv, state) -> tuple:
            turns, loss, n, chars, formatted, windows = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted, windows

        for batch in batches:
            done = []
            for c, skip, text, targets in zip(batch.column("conv_id").to_pylist(), batch.column("n_context").to_pylist(), batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                if state is None or c != conv:
                    if state is not None:
                        done.append(row(conv, state))
                    conv, state = c, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0]
                for role, said in read_turns(text)[skip:]:
                    state[0].update(f"{role}\n{said}\n".encode())
                    state[2] += 1
                for span in targets:
                    said = unescaped(text[span["start"] : span["end"]])
                    state[1].update(said.encode())
                    state[3] += len(said)
                state[4] += len(text)
                state[5] += 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), kinds, strict=True)], names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row(conv, state), kinds, strict=True)], names)

    return windows.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long")


def format_and_read_back(turns: DataFrame, model_path: str) -> DataFrame:
    """digests() of chat_windows(): a row for each conversation. The digests of a long conversation take one task, through which its windows pass one by one."""
    short, cut = window_parts(turns, model_path)
    return digests(short).unionByName(digests(cut.repartition("conv_id").sortWithinPartitions("conv_id", "section", "window")))


def with_probe(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) and conversation -1, which is made of control strings."""
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(probe)
