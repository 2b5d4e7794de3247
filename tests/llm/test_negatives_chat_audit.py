"""Hard negatives, chat windows and the filter audit against brute force, with nulls, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from loomline.llm import audit, chat, negatives, queries

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def brute_negatives(rows, positives=5, wanted=3, low=50, high=95):
    least = {}
    for vec_id, label, v in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        least[vec_id] = min(least.get(vec_id, (label, v)), (label, v))
    whole = {i: (label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, (label, v) in least.items()}
    out = []
    for a, (label, v) in whole.items():
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i, other) for i, (other, w) in whole.items() if i != a)
        for score, p, _ in [x for x in scored if x[2] == label][:positives]:
            fit = [x for x in scored if x[2] != label and low * -score <= 100 * -x[0] <= high * -score]
            out += [(a, p, rank, i, -score, -s) for rank, (s, i, _) in enumerate(fit[:wanted], 1)]
    return sorted(out)


def mined(table, **more):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table, label, F.col("vec_id") % 50 == 0, **more)


EMBEDDINGS = "vec_id long, label int, embedding array<float>, block int, ids string"


@pytest.fixture(scope="module")
def vectors(spark):
    r = random.Random(4)
    vector = lambda n=10: [r.choice([0.0, 0.25, -0.25, r.uniform(-1, 1)]) for _ in range(n)]
    same = vector()
    rows = [(i, r.randrange(4), same if i % 5 == 0 else vector()) for i in range(700)]
    rows += [(1000, None, vector()), (1050, 1, None), (1100, 1, [None, *vector(9)]), (1150, 1, [math.nan, *vector(9)]), (1200, 1, [math.inf, *vector(9)]), (None, 1, vector())]
    rows += [(1250, 1, vector(3)), (1300, 1, []), (1350, 2, vector(12)), (-50, 2, vector()), (50, 3, vector()), (50, 0, vector()), (51, 0, vector()), (1400, 9, same)]
    return rows, spark.createDataFrame([(*x, 1, "x") for x in rows], EMBEDDINGS)


@pytest.mark.parametrize("chunks", [1, 2, 5])
def test_hard_negatives(vectors, chunks, monkeypatch):
    rows, table = vectors
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    monkeypatch.setattr(negatives, "ROWS", 64)
    got = mined(table, chunks=chunks)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows)


def test_hard_negatives_of_little(vectors, spark):
    rows, table = vectors
    assert mined(table.limit(0)).count() == 0 and mined(table.where("vec_id % 50 <> 0")).count() == 0
    assert mined(table.where("vec_id = 0")).count() == 0
    one_label = table.withColumn("label", F.lit(3)).where("vec_id < 300 AND vec_id % 7 > 0")
    assert mined(one_label).count() == 0
    with pytest.raises(Exception, match="53 bits|2\\^53"):
        mined(spark.createDataFrame([(i, 1, [1e30], 1, "x") for i in range(100)], EMBEDDINGS)).collect()


def test_hard_negatives_in_blocks_of_full_size(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = duckdb.sql(queries.OP11_SQL.replace("FROM embeddings", "FROM read_parquet('/root/testdata/sf0.1/embeddings.parquet')")).fetchall()
    assert sorted(map(tuple, mined(table).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())) == sorted(want)


def brute_chat(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        every = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


TURNS = "conv_id long, turn long, role string, text string, section int, tokens string"


@pytest.fixture(scope="module")
def turns(spark):
    r = random.Random(3)
    odd = [*chat.CONTROL, chat.ESCAPE, chat.ESCAPE * 2 + "n", "<", "<|im_end|", "\n", "", "😀é", " ", "word " * 50, None]
    rows = []
    for conv in (None, 1, 2, 3, 4, 5):
        for turn in range(200 if conv in (2, None) else 5):
            role = "system" if turn == 0 and conv in (1, 2) else r.choice(["user", "assistant", "tool", "a\nb<s>␛n", None])
            rows.append((conv, r.choice([turn, turn, max(turn - 1, 1), None if conv != 2 else turn]) if turn else turn, role, None if r.random() < 0.05 else "".join(x or "" for x in r.choices(odd, k=r.choice([1, 3, 30])))))
    rows += [(6, 0, "user", "word " * 200_000), (6, 1, "assistant", "yes"), (7, 0, "system", "s " * 900), (7, 1, "user", "u"), (7, 2, "assistant", "a " * 300), (7, 3, "assistant", "a " * 300)]
    rows += rows[:3]
    return rows, spark.createDataFrame([(*x, 1, "x") for x in rows], TURNS)


@pytest.mark.parametrize("long", [chat.LONG, 3000])
def test_chat_windows(turns, long):
    """Read back whole, in windows within the budget; with `long` small, conversations go through sections."""
    rows, table = turns
    short, cut = chat.window_parts(table, PIECES, budget=300, history=100, section=900, long=long)
    found = chat.digests(short).unionByName(chat.digests(cut.repartition("conv_id").sortWithinPartitions("conv_id", "section", "window"))).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in found} == brute_chat(rows)
    assert (cut.count() > 0) == (long == 3000)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    windows = short.unionByName(cut).collect()
    assert {r["conv_id"]: r["formatted_chars"] for r in found} == dict(collections.Counter({c: sum(len(w["formatted"]) for w in windows if w["conv_id"] == c) for c in {w["conv_id"] for w in windows}}))
    systems = {2: None, 7: None}  # conversations that begin with the system's turn
    for w in sorted(windows, key=lambda w: (w["conv_id"] or 0, w["section"], w["window"])):
        parts = chat.read_turns(w["formatted"])
        assert len(parts) == w["n_turns"] and "".join(chat.formatted_turn(*p) for p in parts) == w["formatted"]
        if len(w["formatted"]) < 100_000:
            assert sum(len(model.encode(chat.formatted_turn(*p))) for p in parts) == w["tokens"]
        assert w["over_budget"] == (w["tokens"] > 300) and (not w["over_budget"] or w["n_turns"] - w["n_context"] == 1)
        new = parts[w["n_context"] :]
        assert [chat.unescaped(w["formatted"][s["start"] : s["end"]]) for s in w["loss"]] == [text for role, text in new if role == "assistant"]
        for control in chat.CONTROL:
            assert w["formatted"].count(control) == (w["n_turns"] if control in (chat.START, chat.END) else 0)
        if w["conv_id"] in systems:
            systems[w["conv_id"]] = systems[w["conv_id"]] or parts[0]
            assert parts[0] == systems[w["conv_id"]] or w["over_budget"] or w["tokens"] + len(model.encode(chat.formatted_turn(*systems[w["conv_id"]]))) > 300
    assert any(w["n_context"] > 1 for w in windows)


def test_chat_of_nothing_and_the_probe(turns, spark):
    table = turns[1]
    assert chat.format_and_read_back(table.limit(0), PIECES).count() == 0
    probe = chat.format_and_read_back(chat.with_probe(spark, table.limit(0)), PIECES).collect()
    said = "</s>[INST] ok [/INST]"
    assert [tuple(r)[:5] for r in probe] == [(-1, *brute_chat([(-1, 0, "user", said), (-1, 1, "assistant", said)])[-1])]


def plain_spans(tokens, budget, history):
    """Greedy windows turn by turn, without prefix sums or a system turn."""
    out, i = [], 0
    while i < len(tokens):
        h = i
        while h > 0 and sum(tokens[h - 1 : i]) <= min(history, budget - tokens[i]):
            h -= 1
        j = i + 1
        while j < len(tokens) and sum(tokens[h : j + 1]) <= budget:
            j += 1
        out.append((False, h, i, j))
        i = j
    return out


def test_spans_by_prefix_sums():
    r = random.Random(1)
    for _ in range(300):
        tokens = [r.choice([1, 3, 10, 40, 120]) for _ in range(r.randrange(1, 30))]
        assert list(chat.spans(tokens, None, True, 0, 100, 25)) == plain_spans(tokens, 100, 25)


def brute_audit(documents, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in documents:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    rows = []
    for i, text, lang in documents:
        t = text or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        tests = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and i > first[t])
        rows.append((lang or "", {c for c, test in zip("ABCDE", tests, strict=True) if test}, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                before = set(order[: step - 1])
                out[part, "".join(order), step] = [len(left) - len(gone), len(gone), sum(f in r[1] and bool(r[1] & before) for r in own), sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                shapley[f] += len(gone)
                left = [r for r in left if f not in r[1]]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


AUDITED = "doc_id long, text string, lang string, mask int, part string, words int, key string"


def test_filter_audit(spark):
    r = random.Random(2)
    pieces = ["word ", "Some ", "THING ", "# ", "a | b ", "é ", "\t\n", "x" * 50 + " "]
    texts = [None, "", " ", "A", "#", "word " * 300, " ".join(f"w{i}" for i in range(250))] + ["".join(r.choices(pieces, k=r.choice([3, 250, 400]))) for _ in range(30)]
    rows = [(i, r.choice(texts), r.choice(["en", "de", "", None])) for i in range(300)] + [(None, texts[5], "en"), (None, texts[5], None), (7, "again", "de"), (7, "again", "de"), (400, "again", "de"), (5000, "word " * 400_000, "long")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 320, 2)] + [(None, 1, 1), (4, 1, 0), (4, 0, 1)]
    docs = spark.createDataFrame([(*x, 1, "p", 1, "k") for x in rows], AUDITED)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.filter_audit(docs, known)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(x)[:3]: tuple(x)[3:] for x in got.collect()} == brute_audit(rows, labels)
    assert got.count() == 4 * 600
    assert audit.filter_audit(docs.limit(0), known).count() == 0 and audit.filter_audit(docs, known.limit(0)).where("good_lost + toxic_lost > 0").isEmpty()


def test_parity_sums_are_inverted_exactly(spark):
    r = random.Random(6)
    rows = [(r.choice("ab"), r.random() < 0.5, r.random() < 0.5, r.randrange(8)) for _ in range(500)]
    table = spark.createDataFrame(rows, "part string, good boolean, toxic boolean, mask int")
    want = collections.defaultdict(lambda: [0, 0, 0])
    for part, good, toxic, mask in rows:
        want[part, mask] = [x + y for x, y in zip(want[part, mask], (1, good, toxic), strict=True)]
    cells = audit.mask_cells(audit.parity_sums(table, 3), 3).collect()
    assert {(x["part"], c["mask"]): [c["n"], c["good"], c["toxic"]] for x in cells for c in x["cells"]} == dict(want)
