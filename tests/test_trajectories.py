"""The trajectory engine: draws, sampler, rendering, validation, splits, sinks."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from loomline.operators import render, report, split, validate
from loomline.operators.render import MESSAGE
from loomline.plans import generate
from loomline.sources import dimensions, jsonl

CALL = {"type": "tool_call", "id": "call_1", "tool_name": "Bash", "arguments": {"command": "pwd"}}
RESULT = {"type": "tool_result", "tool_call_id": "call_1", "output": '{"stdout": "/"}'}
FINAL = {"type": "final_answer", "content": "Bash ran pwd."}


def conversation(call=CALL, result=RESULT, final=FINAL, roles=("system", "user", "assistant", "tool", "assistant"), keep=5):
    text = [x if isinstance(x, str) else json.dumps(x) for x in ("s", "u", call, result, final)]
    return [(r, t, None, None) for r, t in zip(roles, text, strict=True)][:keep]


def without(d, key):
    return {k: v for k, v in d.items() if k != key}


CASES = {
    "good": (conversation(), [], []),
    "few": (conversation(keep=3), ["too few messages"], ["COUNT_MISMATCH"]),
    "null id is a key": (conversation(call=CALL | {"id": None}), [], None),
    "no id": (conversation(call=without(CALL, "id")), ["tool_call missing id"], ["TC_MISSING_ID", "TCID_MISMATCH"]),
    "unknown": (conversation(call=CALL | {"tool_name": "Nope"}), ["unknown tool: Nope"], None),
    "no arguments": (conversation(call=without(CALL, "arguments")), ["tool_call missing arguments"], None),
    "empty answer": (conversation(final=FINAL | {"content": ""}), ["final_answer missing content"], None),
    "broken": (conversation(call="not json"), ["assistant message not valid JSON"], None),
    "tail": (conversation(call='{"type":"tool_call"} tail'), ["assistant message not valid JSON"], None),
    "NaN": (conversation(final='{"type":"final_answer","content":"Bash a","x":NaN}'), None, None),
    "list": (conversation(call="[1]"), ["ASSISTANT_NOT_OBJECT"], None),
    "tool text": (conversation(result="x"), ["tool message not valid JSON"], None),
    "tool type": (conversation(result=RESULT | {"type": "other"}), ["tool message must have type=tool_result"], None),
    "no link": (conversation(result=without(RESULT, "tool_call_id")), ["tool_result missing tool_call_id"], None),
    "banana": (conversation(call=CALL | {"type": "banana"}), [], None),
    "mismatch": (conversation(result=RESULT | {"tool_call_id": "call_2"}), [], ["TCID_MISMATCH"]),
    "placeholder": (conversation(final=FINAL | {"content": "Bash has {count}"}), [], ["ANSWER_PLACEHOLDER"]),
    "vague": (conversation(final=FINAL | {"content": "Done."}), [], ["NOT_GROUNDED", "VAGUE_ANSWER"]),
    "conflict": (conversation(result=RESULT | {"output": '{"exit_code": 0, "note": "error"}'}), [], ["EXIT_CODE_CONFLICT"]),
    "output": (conversation(result=RESULT | {"output": "plain"}), [], ["OUTPUT_NOT_JSON"]),
    "first": (conversation(roles=("user", "user", "assistant", "tool", "assistant")), ["first message must be system"], ["BAD_ALTERNATION"]),
    "missing argument": (conversation(call=CALL | {"arguments": {}}), [], ["MISSING_ARG"]),
    "mark": (conversation(call=CALL | {"id": "{{TOOL_CALL_ID}}"}, result=RESULT | {"tool_call_id": "{{TOOL_CALL_ID}}"}), [], ["UNSUBSTITUTED_ID", "UNSUBSTITUTED_TCID"]),
}


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], f"id string, messages {MESSAGE.simpleString()}").cache()


def test_structural_issues(cases):
    got = {r["id"]: r["issues"] for r in validate.structural_issues(cases).collect()}
    assert {k: got[k] for k, v in CASES.items() if v[1] is not None} == {k: v[1] for k, v in CASES.items() if v[1] is not None}


def test_critic_codes(cases):
    got = {}
    for r in validate.critique(cases).collect():
        got.setdefault(r["id"], []).append(r["code"])
    for name, (_, _, codes) in CASES.items():
        if codes and codes[0]:
            assert sorted(got.get(name, [])) == sorted(codes), name
    assert "good" not in got


def test_bulk_rows_are_valid_and_linked(spark):
    made = generate.bulk(spark, 600).cache()
    assert made.where(F.size("messages") != 5).isEmpty()
    stats = validate.batch_stats(validate.structural_issues(made)).first()
    assert (stats["total"], stats["invalid"]) == (600, 0)
    for r in made.limit(50).collect():
        call, result = json.loads(r["messages"][2]["content"]), json.loads(r["messages"][3]["content"])
        assert call["id"] == result["tool_call_id"] == r["messages"][3]["tool_call_id"]
        json.loads(result["output"])


def test_fresh_picks_are_distinct(spark):
    picks = generate.with_intents(spark, generate.bulk_draws(spark, 3000), 3000, prefix=64).where("fresh_rank IS NOT NULL")
    assert picks.groupBy("tool_name", "query").count().where("count > 1").isEmpty()
    assert picks.where("tool_name = 'Bash'").count() == 37


def test_dimension_sizes(spark):
    assert len(dimensions.LOCALES) == 38 and abs(sum(t[2] for t in dimensions.TOOLS) - 9.1) < 1e-9
    per = {r["tool_name"]: r["count"] for r in dimensions.intents(spark).groupBy("tool_name").count().collect()}
    assert per == {"Bash": 37, "Grep": 12, "TodoWrite": 6, "TodoRead": 5, "Glob": 15, "Web_Search": 15, "Web_Fetch": 10, "Read": 25, "Write": 12, "Edit": 15}
    sizes = {r["dataset"]: len(r["locales"]) for r in generate.config_locales(spark).collect()}
    assert list(sizes[c[0]] for c in dimensions.CONFIGS) == [2, 7, 3, 2, 10, 3, 3, 2, 38, 20]


@pytest.mark.parametrize(("n", "sizes"), [(1000, (700, 150, 150)), (90, (62, 13, 15)), (1, (0, 0, 1)), (0, (0, 0, 0))])
def test_split_sizes(spark, n, sizes):
    placed = split.split_70_15_15(spark.range(n), "id", 3)
    rows = placed.collect()
    assert sorted(r["pos"] for r in rows) == list(range(n))
    assert tuple(sum(r["split"] == s for r in rows) for s in ("train", "eval", "test")) == sizes


def test_line_counts(spark):
    texts = ["", "a", "a\n", "a\r\nb", "a\n\n", "x\x0by\x85z"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", render.lines(F.col("t")).alias("n")).collect()
    assert [r["n"] for r in sorted(got)] == [len(t.splitlines()) for t in texts]


def test_jsonl_round_trip(spark, tmp_path):
    made = split.split_70_15_15(generate.bulk(spark, 40), "id", 1)
    jsonl.write(made, str(tmp_path / "out"), ["split"])
    back = jsonl.read(spark, str(tmp_path / "out")).cache()
    assert back.count() == 40 and back.where("size(tools) <> 10").isEmpty()
    line = json.loads(next((tmp_path / "out" / "split=train").glob("*.json")).read_text().splitlines()[0])
    assert "tool_call_id" not in line["messages"][0] and line["messages"][3]["tool_call_id"]


def test_report_ties_keep_first_seen_order(spark):
    rows = spark.createDataFrame([("d", 1, "b"), ("d", 2, "a"), ("d", 3, None)], "dataset string, id long, tool string")
    top = report.top(report.distribution(rows, ["tool"]), 3).orderBy("rank").collect()
    assert [r["value"] for r in top] == ["b", "a", "?"]


def test_valid_rows_are_rendered_once(spark):
    """The filter on issues must not make the messages again: Spark would move it below the rendering and name that several times."""
    made = generate.library_batch(spark, 10, generated_at="now")
    assert made._jdf.queryExecution().optimizedPlan().toString().count("You are a command-line assistant") == 1
    assert made.count() == 10


def test_locale_cross_product_deals_out_its_ids(spark):
    """A small supplier file is one task's to read; what is made of its ids must not be."""
    import __spark_entry__

    plan = __spark_entry__.queries()["gen_locale_cross_product"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
