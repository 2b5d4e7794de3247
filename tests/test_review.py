"""One parse of each content, checks over turns of conversations of any length, running sums, JSON text and rounding."""

from __future__ import annotations

import json
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.json_text import dumps, dumps_text
from loomline.functions.payload import payload
from loomline.functions.rounding import one_decimal
from loomline.operators import validate
from loomline.operators.fold import running, to_rows
from loomline.plans import cases, review_queries
from loomline.sources import dimensions

TOOLS = frozenset(dimensions.TOOL_NAMES)


def turns_of(records):
    return records.select("id", F.posexplode("messages").alias("turn", "m")).select("id", "turn", "m.role", "m.content")


def plain_issues(messages):
    """The validator's rules one message at a time, on what json.loads gives."""
    if len(messages) < 4:
        return ["too few messages"]
    out = [text for role, want, text in zip((messages[0][0], messages[1][0], messages[-1][0]), ("system", "user", "assistant"), validate.PLACES, strict=True) if role != want]
    for role, text in messages:
        if role not in ("assistant", "tool"):
            continue
        try:
            value = json.loads(text)
        except ValueError:
            out.append(f"{role} message not valid JSON")
            continue
        if not isinstance(value, dict):
            out.append(f"{role.upper()}_NOT_OBJECT")
        elif role == "tool":
            out += [] if value.get("type") == "tool_result" else ["tool message must have type=tool_result"]
            out += [] if "tool_call_id" in value else ["tool_result missing tool_call_id"]
        elif value.get("type") == "tool_call":
            out += [] if "id" in value else ["tool_call missing id"]
            out += [] if value.get("tool_name") in dimensions.TOOL_NAMES else [f"unknown tool: {value.get('tool_name')}"]
            out += [] if "arguments" in value else ["tool_call missing arguments"]
        elif value.get("type") == "final_answer" and not value.get("content"):
            out.append("final_answer missing content")
    return out


@pytest.fixture(scope="module")
def odd(spark):
    """Conversations of contents put together at random."""
    r = random.Random(5)
    values = ["1", "null", "NaN", '""', '"x"', "[]", "{}", "true", "0.0", "-0", '"Bash"', '"\\ud800"', '{"command":"pwd"}', "1e400"]
    names = ["type", "id", "tool_name", "arguments", "content", "tool_call_id", "output"]

    def content():
        kind = r.choice(['"tool_call"', '"final_answer"', '"tool_result"', "null", "1"])
        body = "{" + ",".join([f'"type":{kind}'] + [f'"{r.choice(names)}":{r.choice(values)}' for _ in range(r.randrange(6))]) + "}"
        return r.choice([body] * 8 + [body + " x", body.replace('"', "'"), "[1]", "", "[" * 100_000, "9" * 5000, None])

    rows = [(i, [(role, content()) for role in ["system", "user", *r.choices(["assistant", "tool", "user", "system"], k=r.randrange(8))]]) for i in range(150)]
    return rows, spark.createDataFrame([(i, [(role, text, None, None) for role, text in m]) for i, m in rows], "id long, messages array<struct<role: string, content: string, tool_call_id: string, name: string>>")


def test_issues_of_odd_contents(odd):
    rows, table = odd
    want = {}
    for i, messages in rows:
        safe = [(role, "x" if text is None or len(text) >= 5000 else text) for role, text in messages]
        want[i] = [x.encode("utf-8", "replace").decode() for x in plain_issues(safe)]
    got = {r["id"]: r["issues"] for r in validate.structural_issues(table).collect()}
    assert got == want
    by_turn = {}
    for r in validate.turn_issues(turns_of(table)).orderBy(F.col("turn").isNotNull(), "turn").collect():
        by_turn.setdefault(r["id"], []).append(r["issue"])
    assert {i: sorted(x) for i, x in by_turn.items()} == {i: sorted(x) for i, x in want.items() if x}


def test_codes_of_records_and_turns_agree(odd, spark):
    for table in (odd[1], cases.trajectories(spark)):
        table = table.withColumn("id", F.col("id").cast("string"))
        key = lambda r: (r["id"], r["turn"], r["code"], r["category"])
        records, turns = validate.critique(table).collect(), validate.turn_codes(turns_of(table)).collect()
        assert len(records) > 20 and sorted(map(key, records), key=str) == sorted(map(key, turns), key=str)


def test_one_parse_says_both():
    assert payload('{"type":"tool_call","tool_name":"Nope","x":NaN}', TOOLS)["tool_known"] is False
    assert payload('{"tool_name":"Nope","tool_name":"Bash"}', TOOLS)["tool_known"] is True
    assert payload('{"arguments":"{\\"command\\":\\"pwd\\"}"}', TOOLS)["arguments_kind"] == "text"
    assert payload("[1]", TOOLS) == {"json": "other"} and payload("{'a':1}", TOOLS) == payload(None, TOOLS) == {}
    assert payload('{"id":"\\ud800"}', TOOLS)["id"] == "?" and payload('{"id":1}', TOOLS)["id_key"] != payload('{"id":"1"}', TOOLS)["id_key"]


def test_a_conversation_over_many_tasks(spark):
    """One conversation of 200,000 turns and a few short ones: dealt to many tasks, with the windows' answers."""
    n = 200_000
    role = F.when(F.col("turn") % 7 == 3, "user").when(F.col("turn") % 2 == 0, "user").otherwise("assistant")
    long = spark.range(n).select(F.lit(1).cast("long").alias("id"), F.col("id").alias("turn"), role.alias("role"))
    short = spark.range(90).select((F.col("id") % 30 + 2).alias("id"), F.col("id").alias("turn"), F.lit("user").alias("role"))
    rows = long.unionByName(short).withColumn("content", F.lit("x"))
    got = running(rows, ["id"], ["turn"], sums={"place": F.lit(1)}, before={"before": F.col("role")}, parts=16, part="part").cache()
    per_part = [r["count"] for r in got.groupBy("part").count().collect()]
    assert len(per_part) == 16 and max(per_part) < 2 * n / 16
    by_id = Window.partitionBy("id").orderBy("turn")
    want = rows.withColumn("place", F.row_number().over(by_id)).withColumn("before", F.lag("role").over(by_id))
    assert got.drop("part").exceptAll(want.select(*got.drop("part").columns)).isEmpty() and got.count() == n + 90
    facts = {r["id"]: r for r in validate.sequence_facts(rows).collect()}
    roles = ["user" if t % 7 == 3 or t % 2 == 0 else "assistant" for t in range(n)]
    assert facts[1]["repeats"] == sum(a == b for a, b in zip(roles, roles[1:], strict=False)) and facts[2]["repeats"] == 2 and facts[1]["last"] == roles[-1]
    sent = to_rows(got, spark.createDataFrame([(1, "a"), (2, "b")], "id long, fact string"), ["id"], "part")
    assert sent.where("fact = 'a'").count() == n and sent.where("fact = 'b'").count() == 3 and sent.count() == n + 90


def test_running_sums_with_null_keys_and_odd_names(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", "b", "b", None]), r.choice([None, 1, 2]), i, r.choice([None, 3, -4]), i) for i in range(500)]
    table = spark.createDataFrame(rows, "k0 string, part int, at long, s0 int, row long")
    got = running(table, ["k0", "part"], ["at"], sums={"total": F.col("s0")}, before={"earlier": F.col("s0")}, parts=5)
    by = Window.partitionBy("k0", "part").orderBy("at")
    want = table.withColumn("total", F.coalesce(F.sum("s0").over(by.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))).withColumn("earlier", F.lag("s0").over(by))
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and got.count() == 500
    assert running(table.limit(0), ["k0"], ["at"], sums={"n": F.lit(1)}).count() == 0
    assert running(table, [], ["at"], sums={"n": F.lit(1)}, parts=5).where("n <> at + 1").isEmpty()


def test_payload_turns_hold_every_form(spark):
    rows = spark.range(400).select((F.col("id") / 4).cast("long").alias("conv_id"), (F.col("id") % 4).alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.lit('a "b"\n').alias("text"))
    issues = {r["issue"] for r in validate.turn_issues(review_queries.payload_turns(rows)).collect()}
    assert {"unknown tool: Nope", "unknown tool: None", "assistant message not valid JSON", "ASSISTANT_NOT_OBJECT", "tool_call missing id", "tool_result missing tool_call_id", "final_answer missing content"} <= issues


def test_json_text_byte_for_byte(spark):
    r = random.Random(1)
    texts = ["", 'a"b\\c', "".join(map(chr, range(300))), "\\u001F", "\U0010ffff"] + ["".join(chr(r.choice([r.randrange(128), r.randrange(128, 0xD800), r.randrange(0x10000, 0x110000)])) for _ in range(r.randrange(40))) for _ in range(300)]
    for x in spark.createDataFrame([(t,) for t in texts], "t string").select("t", dumps_text(F.col("t")).alias("a"), dumps_text(F.col("t"), False).alias("b")).collect():
        assert x["a"] == json.dumps(x["t"]) and x["b"] == json.dumps(x["t"], ensure_ascii=False)
    kind = T.StructType.fromDDL("a string, b array<struct<c: int, d: map<string, array<boolean>>>>, e struct<f: string>, g bigint")
    rows = [("é\n", [(1, {"k": [True, None], "ü": None}), None, (None, {})], ("x",), None), (None, [], None, 5), (None, None, (None,), -1)]
    table = spark.createDataFrame([(x,) for x in rows], T.StructType([T.StructField("v", kind)]))
    for x in table.select("v", dumps(F.col("v"), kind).alias("j"), dumps(F.col("v"), kind, False).alias("k")).collect():
        assert json.loads(x["j"]) == x["v"].asDict(True) and x["j"] == json.dumps(json.loads(x["j"])) and x["k"] == json.dumps(json.loads(x["k"]), ensure_ascii=False)
    with pytest.raises(TypeError):
        dumps(F.lit(1.0), T.DoubleType())


def test_one_decimal_as_python_rounds(spark):
    r = random.Random(3)
    xs = [r.choice([r.random() * 100, r.randrange(10**6) / r.choice([1000, 8, 16, 20, 7]), r.randrange(1 << 47) / r.choice([1, 2, 4, 8, 1024.0]), (2 * r.randrange(10**5) + 1) / 20]) for _ in range(100_000)]
    xs += [0.0, -0.0, 0.05, 0.15, 0.25, 12.25, 12.35, 99.95, -0.04, -12.25, math.nan, math.inf, -math.inf]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", one_decimal(F.col("x")).alias("y")).collect()
    assert [x["y"] for x in got] == [f"{x:.1f}" for x in xs]
