"""Damaged lines, draws from tables, reports by batches, micro-batches with failures, splits read alone, repair until nothing changes."""

from __future__ import annotations

import collections
import hashlib
import json
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomline.functions.draws import uniform
from loomline.operators import increments, picks, repair, report, split, validate
from loomline.operators.render import MESSAGE
from loomline.plans import cases, cli, generate
from loomline.plans.review_queries import payload_records, payload_turns
from loomline.sources import dimensions, jsonl, records
from loomline.streaming import counts

GOOD = '{"messages": [{"role": "user", "content": "a\\u00e9\\ud83d\\ude00", "extra": 1}], "metadata": {"num_tools": 2, "success": true}, "tools": [{"function": {"parameters": {"properties": {"p": {"type": "string"}}}}}]}'
LINES = {
    GOOD: None,
    '{"messages": [], "messages": [{"role": "user"}]}': None,
    "": "blank",
    " \t": "blank",
    "{broken": "not JSON",
    GOOD + " {}": "not JSON",
    GOOD.replace('"', "'"): "not JSON",
    "[" * 100_000: "not JSON",
    "[1]": "not an object",
    "5": "not an object",
    '{"messages": 5}': "messages is not array",
    '{"messages": [5]}': "messages[0] is not struct",
    '{"messages": [{"role": 1}]}': "messages[0].role is not string",
    '{"messages": [null]}': "a message is null",
    '{"messages": null}': "no messages",
    "{}": "no messages",
    '{"messages": [], "metadata": {"num_tools": 1.5}}': "metadata.num_tools is not integer",
    '{"messages": [], "metadata": {"success": 1}}': "metadata.success is not boolean",
    '{"messages": [{"role": "\\ud800"}]}': None,
}


def test_damaged_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    (tmp_path / "in" / "b.json").write_text(GOOD + "\r\n" + "{\r\n", encoding="utf-8")
    (tmp_path / "in" / "c.json").write_text("")
    path = str(tmp_path / "in")
    found = records.scan(spark, path).collect()
    got = {r["line"].rstrip("\r"): r["reason"] for r in found if r["file"].endswith("a.json")}
    assert got == LINES and len(found) == len(LINES) + 2
    good = records.read(spark, path).collect()
    assert len(good) == 1 + sum(v is None for v in LINES.values())
    whole = next(r for r in good if r["metadata"])
    assert whole["messages"][0]["content"] == "aé😀" and whole["metadata"]["num_tools"] == 2 and whole["tools"][0]["function"]["parameters"]["properties"]["p"]["type"] == "string"
    bad = [v for v in LINES.values() if v not in (None, "blank")] + ["not JSON"]
    assert sorted(r["reason"] for r in records.read_rejects(spark, path).collect()) == sorted(bad)
    loaded = records.load(spark, path, str(tmp_path / "rejects"))
    assert loaded.count() == len(good) and loaded.columns == records.RECORD.names
    kept = [json.loads(x) for f in (tmp_path / "rejects").glob("*.json") for x in f.read_text().splitlines()]
    assert sorted(x["reason"] for x in kept) == sorted(bad) and all(x["file"].endswith(".json") and x["line"] for x in kept)
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        jsonl.read(spark, path).collect()


def draw(stream, seed, row, digits=8):
    return int(hashlib.md5(f"{seed}|{stream}|{row}".encode()).hexdigest()[:digits], 16) / 16**digits


def test_picks_without_replacement_one_by_one(spark):
    """Against the sampler as a loop with a set of used items; one key has two rows in three, one has no pool."""
    key = F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 15 == 2, "none").when(F.col("id") % 15 == 5, F.lit(None)).otherwise("small")
    rows = spark.range(3000).select("id", key.alias("key"))
    pool = [("hot", i) for i in range(900)] + [("small", i) for i in range(5000, 5007)] + [("unused", 1), (None, 2)]
    order = collections.defaultdict(list)
    for k, i in pool:
        order[k].append(i)
    for k, items in order.items():
        items.sort(key=lambda i, k=k: (hashlib.md5(f"7|perm|{k}|{i}".encode()).hexdigest(), i))
    used, want = collections.Counter(), {}
    for r in rows.orderBy("id").collect():
        items = order[r["key"]] if r["key"] else []
        rank = None
        if draw("fresh", 7, r["id"]) < 0.8:
            used[r["key"]] += 1
            rank = used[r["key"]] if used[r["key"]] <= len(items) else None
        want[r["id"]] = (rank, items[(rank or int(draw("intent", 7, r["id"]) * len(items)) + 1) - 1] if items else None)
    table = spark.createDataFrame(pool, "key string, id long")
    for most in (picks.BROADCAST_ROWS, 0):  # copied items go to all tasks, or are shuffled
        with pytest.MonkeyPatch.context() as m:
            m.setattr(picks, "BROADCAST_ROWS", most)
            m.setattr(picks, "PER_COPY", 20)
            got = {r["id"]: (r["fresh_rank"], r["pick"]) for r in picks.without_replacement(rows, table, 7).collect()}
        assert got == want
    fresh = [p for rank, p in want.values() if rank]
    assert len(fresh) == len(set(fresh)) == 907
    assert picks.without_replacement(rows.limit(0), table, 7).count() == 0
    assert rows.where(uniform("fresh", 7, F.col("id")) < 0.8).count() < 3000


def test_draws_by_weight(spark):
    """Against a walk through running weights; one row holds most of the weight, some hold none."""
    weights = [(i, w) for i, w in enumerate([0, 5, None, 1, 100_000, -3, 1, 2] + [3] * 200)]
    total = sum(max(0, w or 0) for _, w in weights)
    got = {r["id"]: r["pick"] for r in picks.by_weight(spark.range(2000), spark.createDataFrame(weights, "id long, weight int"), 11).collect()}
    for i in range(2000):
        at = min(int(draw("weight", 11, i, 13) * total), total - 1)
        for k, w in weights:
            at -= max(0, w or 0)
            if at < 0:
                break
        assert got[i] == k
    assert len(got) == 2000 and len(set(got.values())) > 5
    plan = picks.by_weight(spark.range(10), spark.createDataFrame(weights, "id long, weight int"), 11)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    nothing = picks.by_weight(spark.range(3), spark.createDataFrame([(1, 0)], "id long, weight int"), 11)
    assert [r["pick"] for r in nothing.collect()] == [None] * 3


def test_report_by_batches(spark, tmp_path):
    rows = spark.range(1000).select(F.concat(F.lit("d"), F.col("id") % 2).alias("dataset"), "id", F.when(F.col("id") % 5 > 0, F.concat(F.lit("k"), F.col("id") % 7)).alias("tool"), (F.col("id") % 3).alias("level"))
    want = sorted(map(tuple, report.distribution(rows, ["tool", "level"]).collect()))
    state = str(tmp_path / "state")
    for batch in (2, 0, 1, 2):  # in any order, one of them again
        part = rows.where(F.floor(F.col("id") / 400) == batch)
        increments.add_batches(increments.partial_counts(part, ["tool", "level"], F.lit(batch)), state)
    assert sorted(map(tuple, increments.merged(spark, state).collect())) == want
    increments.compact(spark, state, str(tmp_path / "compact"), below=2)
    assert sorted(map(tuple, increments.merged(spark, str(tmp_path / "compact")).collect())) == want
    kept = spark.read.parquet(str(tmp_path / "compact"))
    assert {r["batch"] for r in kept.select("batch").distinct().collect()} == {1, 2}


def write_lines(folder, name, n, first=0):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"messages": [{"role": "user", "content": "x" * (first + i)}]}) + "\n" for i in range(n)) + "{damaged\n")


def test_a_failed_batch_runs_again(spark, tmp_path):
    for k in range(4):
        write_lines(tmp_path / "in", f"{k}.json", 10, 10 * k)
    stream = lambda: counts.lines_of(spark, str(tmp_path / "in"), files_per_batch=1).select(F.lit("d").alias("dataset"), F.coalesce(F.length(F.get("messages", F.lit(0))["content"]), F.lit(-1)).cast("long").alias("id"), F.coalesce("reason", F.lit("good")).alias("state"))
    state, checkpoint = str(tmp_path / "state"), str(tmp_path / "checkpoint")
    tries = []

    def fails_once(rows, number):
        increments.add_batches(increments.partial_counts(rows, ["state"], F.lit(number)), state)
        tries.append(number)
        if tries == [0, 1]:
            raise RuntimeError("after the write, before the batch is done")

    with pytest.raises(Exception, match="after the write"):
        counts.run_batches(stream(), fails_once, checkpoint)
    counts.run_batches(stream(), fails_once, checkpoint)
    assert tries == [0, 1, 1, 2, 3]
    got = {r["value"]: (r["n"], r["first_seen"]) for r in increments.merged(spark, state).collect()}
    assert got == {"good": (40, 0), "not JSON": (4, -1)}
    write_lines(tmp_path / "in", "more.json", 5, 100)
    counts.report_batches(stream(), ["state"], state, checkpoint)
    assert {r["value"]: r["n"] for r in increments.merged(spark, state).collect()} == {"good": 45, "not JSON": 5}


def test_totals_that_the_stream_keeps(spark, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for k in range(3):  # a run for each of three files, each going on where the one before stopped
        write_lines(tmp_path / "in", f"{k}.json", 10 + k)
        lines = counts.lines_of(spark, str(tmp_path / "in")).withColumn("state", F.coalesce("reason", F.lit("good")))
        counts.total_batches(lines, ["state"], {"n": F.lit(1)}, out, checkpoint)
    rows = spark.read.parquet(out)
    assert rows.count() == 6 and {r["state"]: r["n"] for r in counts.latest(rows, ["state"]).collect()} == {"good": 33, "not JSON": 3}


def test_one_split_is_read_and_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "splits")
    made = split.split_70_15_15(spark.range(1000), "id", 3)
    split.write_splits(made, path)
    plan = split.read_split(spark, path, "eval", made.schema)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    before = {f.name for f in (tmp_path / "splits" / "split=train").iterdir()}
    split.write_splits(spark.range(5).select("id", F.lit(0).cast("long").alias("pos"), F.lit("eval").alias("split")), path)
    assert {s: split.read_split(spark, path, s, made.schema).count() for s in ("train", "eval", "test")} == {"train": 700, "eval": 5, "test": 150}
    assert {f.name for f in (tmp_path / "splits" / "split=train").iterdir()} == before


def plain_codes(messages):
    """The review codes of one record, by loops over what json.loads gives."""
    t, out = [], []
    for role, text in messages:
        try:
            value = json.loads(text) if role in ("assistant", "tool") and text is not None else None
        except (ValueError, RecursionError):
            value = None
        t.append((role, value if isinstance(value, dict) else {}))
    calls = [v for role, v in t if role == "assistant" and v.get("type") == "tool_call"]
    required = {name: [a for a, _, r in args if r] for name, _, _, _, args in dimensions.TOOLS}
    for i, (role, v) in enumerate(t):
        add = lambda code, test, i=i: out.append((i, code)) if test else None
        if role == "assistant" and v.get("type") == "tool_call":
            name, args = v.get("tool_name"), v.get("arguments")
            add("TC_MISSING_ID", "id" not in v)
            add("TC_MISSING_TOOL", "tool_name" not in v)
            add("TC_BAD_ARGS", not isinstance(args, dict))
            add("UNKNOWN_TOOL", "tool_name" in v and name not in required)
            add("MISSING_ARG", name in required and any(a not in (args if isinstance(args, dict) else {}) for a in required[name]))
            add("EMPTY_ID", "id" in v and not str("" if v["id"] is None else v["id"]).strip(" "))
            add("UNSUBSTITUTED_ID", v.get("id") == validate.ID_MARK)
        if role == "tool" and v.get("type") == "tool_result":
            output, link = v.get("output"), v.get("tool_call_id")
            add("TR_MISSING_TCID", "tool_call_id" not in v)
            add("UNSUBSTITUTED_TCID", link == validate.ID_MARK)
            add("TCID_MISMATCH", "tool_call_id" not in v or not any(type(c.get("id")) is type(link) and c.get("id") == link for c in calls))
            try:
                inner, ok = json.loads(output) if isinstance(output, str) else output, output is not None
            except ValueError:
                inner, ok = None, False
            shown = output if isinstance(output, str) else json.dumps(output)
            add("OUTPUT_NOT_JSON", not ok)
            add("OUTPUT_PLACEHOLDER", output is not None and re.search(validate.PLACEHOLDER, shown))
            add("EXIT_CODE_CONFLICT", isinstance(inner, dict) and type(inner.get("exit_code")) in (int, float) and inner["exit_code"] == 0 and "error" in shown.lower())
        if role == "assistant" and v.get("type") == "final_answer":
            answer = "" if v.get("content") is None else str(v["content"])
            add("FA_MISSING_CONTENT", "content" not in v)
            add("VAGUE_ANSWER", answer.lower().strip(" ") in validate.VAGUE)
            add("ANSWER_PLACEHOLDER", re.search(validate.PLACEHOLDER, answer))
            add("HALLUCINATION", any(a in answer.lower() and b in answer.lower() for a, b in validate.CONTRADICTIONS))
            tools = [str(c["tool_name"]) for c in calls if c.get("tool_name") is not None]
            add("NOT_GROUNDED", tools and not any(n in answer for n in tools))
    roles = [role for role, _ in messages if role != "system"]
    if roles:
        results = sum(role == "tool" and v.get("type") == "tool_result" for role, v in t)
        tests = {"BAD_FIRST_ROLE": roles[0] != "user", "BAD_LAST_ROLE": roles[-1] != "assistant", "COUNT_MISMATCH": len(calls) != results, "BAD_ALTERNATION": any(a == b for a, b in zip(roles, roles[1:], strict=False))}
        out += [(None, code) for code, test in tests.items() if test]
    return out


def plain_until_clean(name, messages):
    for rounds in range(30):
        codes = plain_codes(messages)
        fixed = repair.repaired(name, [text for _, text in messages], codes)
        if fixed == [text for _, text in messages]:
            return rounds, sorted({code for _, code in codes}), messages
        messages = [(role, text) for (role, _), text in zip(messages, fixed, strict=True)]
    raise AssertionError("no end")


def test_repair_until_nothing_changes(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    table = payload_records(payload_turns(conversations)).select(F.col("id").cast("string").alias("id"), "messages").unionByName(cases.trajectories(spark))
    want = {r["id"]: plain_until_clean(r["id"], [(m["role"], m["content"]) for m in r["messages"]]) for r in table.collect()}
    got = {r["id"]: (r["rounds"], r["codes"], [(m["role"], m["content"]) for m in r["messages"]]) for r in repair.until_clean(table).collect()}
    assert got == want
    assert max(rounds for rounds, _, _ in got.values()) >= 2 and sum(not codes for _, codes, _ in got.values()) > 10
    assert not {"TC_MISSING_ID", "EMPTY_ID", "TC_BAD_ARGS", "OUTPUT_NOT_JSON", "VAGUE_ANSWER", "ANSWER_PLACEHOLDER"} & {c for _, codes, _ in got.values() for c in codes}
    assert repair.until_clean(table.limit(0)).count() == 0
    stopped = {r["id"]: r["rounds"] for r in repair.until_clean(table, rounds=1).collect()}
    assert set(stopped) == set(got) and max(stopped.values()) == 1
    no_messages = spark.createDataFrame([("a", None)], f"id string, messages {MESSAGE.simpleString()}")
    assert [(r["rounds"], r["codes"]) for r in repair.until_clean(no_messages).collect()] == [(0, [])]


def json_lines(folder):
    return [json.loads(line) for f in sorted(folder.glob("*.json")) for line in f.read_text().splitlines()]


def test_jobs_on_files(spark, tmp_path):
    """validate, stats, replay, convert and clean over written trajectories, damaged lines and records with every issue and code."""
    files = tmp_path / "in"
    jsonl.write(generate.bulk(spark, 40), str(files / "bulk"))
    (files / "bulk" / "more.json").write_text("{damaged\n\n[1]\n" + "".join(json.dumps({"messages": [{"role": r, "content": c} for r, c in m]}) + "\n" for m in cases.CASES.values()))
    n = len({json.dumps(m) for m in cases.CASES.values()})
    assert n == len(cases.CASES)

    def run(job, *more, source=files / "bulk"):
        return cli.run_on_files(spark, cli.file_arguments([job, "--input", str(source), *more]))

    valid = sum(not plain for plain in (r["issues"] for r in validate.structural_issues(cases.trajectories(spark)).collect()))
    out = {k: str(tmp_path / k) for k in ("bad", "comments", "rejects")}
    assert run("validate", "--bad-rows", out["bad"], "--comments", out["comments"], "--rejects", out["rejects"]) == [f"total {40 + n}", f"valid {40 + valid}", f"invalid {n - valid}", "rejected lines 2"]
    assert {x["reason"] for x in json_lines(tmp_path / "rejects")} == {"not JSON", "not an object"} and len({x["code"] for x in json_lines(tmp_path / "comments")}) == 22
    lines = run("stats")
    assert sum(int(x.split(":")[1].split("(")[0]) for x in lines if x.startswith("tool_name ")) == 40 + n and any(x.startswith("tool_name ? ") for x in lines)
    sample = run("replay", "--sample", "7", "--seed", "3")
    assert len(set(sample)) == 7 and sample == run("replay", "--sample", "7", "--seed", "3") and sample != run("replay", "--sample", "7", "--seed", "4") and all("messages" in json.loads(x) for x in sample)
    assert run("convert", "--output", str(tmp_path / "training")) == [f"converted {40 + n}"]
    assert all(set(m) <= {"role", "content"} for x in json_lines(tmp_path / "training") for m in x["messages"])
    said = run("clean", "--output", str(tmp_path / "clean"))
    cleaned = json_lines(tmp_path / "clean")
    assert said[0] == f"records {40 + n}" and len(cleaned) == 40 + n and said[2] == f"with codes left {sum('codes' in x for x in cleaned)}" and sum("metadata" in x for x in cleaned) == 40
    again = run("clean", "--output", str(tmp_path / "again"), source=tmp_path / "clean")
    assert again[1:] == ["repaired 0", said[2]]
    with pytest.raises(SystemExit):
        cli.file_arguments(["validate"])


def test_only_a_slice_of_a_batch_is_parsed_at_a_time(monkeypatch):
    """Lines and contents of one batch become Python objects slice by slice, and give what they give at once."""
    from loomline.functions import payload
    from loomline.functions.slices import slices

    texts = pa.array([None, "", "x" * 30, '{"type":"tool_call","id":null}', "[1]", "é" * 9, None, '{"type":"final_answer"}'])
    parts = list(slices(texts, most=25, rows=3))
    assert pa.concat_arrays(parts) == texts and all(len(p) <= 3 for p in parts) and len(parts) > 3
    assert list(slices(pa.array([], pa.string()))) == []
    seen = []
    monkeypatch.setattr(payload, "slices", lambda a: seen.extend(p := list(slices(a, 25, 3))) or p)
    whole = payload.payload_array(texts, frozenset())
    assert whole.to_pylist() == [{n: payload.payload(t, frozenset()).get(n) for n in payload.ALL} for t in texts.to_pylist()]
    few = payload.payload_array(texts.slice(2), frozenset(), payload.VALIDATED)
    assert few.to_pylist() == [{n: p[n] for n in payload.VALIDATED} for p in whole.to_pylist()[2:]] and len(seen) > 5


def test_lines_are_scanned_slice_by_slice(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("".join(f'{{"messages": [{{"role": "user", "content": "{i}"}}]}}\n' if i % 5 else "{\n" for i in range(2503)))
    rows = records.scan(spark, str(tmp_path / "in")).select("reason", F.get("messages", F.lit(0))["content"].alias("c")).collect()
    assert sum(r["reason"] == "not JSON" for r in rows) == 501 and {r["c"] for r in rows if not r["reason"]} == {str(i) for i in range(2503) if i % 5}
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(8 << 20)
