"""Small conversations that hold each validator error and each review code once or more; (id, turn, role, content) rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators.render import MESSAGE
from loomline.operators.validate import ID_MARK

CALL = {"type": "tool_call", "id": "call_1", "tool_name": "Bash", "arguments": {"command": "pwd"}}
RESULT = {"type": "tool_result", "tool_call_id": "call_1", "output": '{"stdout": "/"}'}
FINAL = {"type": "final_answer", "content": "Bash ran pwd."}
ROLES = ("system", "user", "assistant", "tool", "assistant")


def conversation(call=CALL, result=RESULT, final=FINAL, roles=ROLES, keep: int = 5) -> list[tuple[str, str]]:
    texts = [x if isinstance(x, str) else json.dumps(x) for x in ("s", "u", call, result, final)]
    return list(zip(roles, texts, strict=True))[:keep]


def without(payload: dict, key: str) -> dict:
    return {k: v for k, v in payload.items() if k != key}


CASES: dict[str, list[tuple[str, str]]] = {
    "good": conversation(),
    "none": [],
    "three messages": conversation(keep=3),
    "first role": conversation(roles=("user", "user", "assistant", "tool", "assistant")),
    "second role": conversation(roles=("system", "assistant", "assistant", "tool", "assistant")),
    "last role": conversation(roles=("system", "user", "assistant", "tool", "tool")),
    "call is no JSON": conversation(call="not json"),
    "call with a tail": conversation(call='{"type":"tool_call"} tail'),
    "call is a list": conversation(call="[1]"),
    "call is a number": conversation(call="12"),
    "call in single quotes": conversation(call="{'type': 'tool_call'}"),
    "call of another type": conversation(call=CALL | {"type": "banana"}),
    "call without id": conversation(call=without(CALL, "id")),
    "call with null id": conversation(call=CALL | {"id": None}),
    "call with blank id": conversation(call=CALL | {"id": "  "}, result=RESULT | {"tool_call_id": "  "}),
    "call without tool": conversation(call=without(CALL, "tool_name")),
    "call of unknown tool": conversation(call=CALL | {"tool_name": "Nope"}, final=FINAL | {"content": "Nope ran."}),
    "call without arguments": conversation(call=without(CALL, "arguments")),
    "call with text as arguments": conversation(call=CALL | {"arguments": "pwd"}),
    "call with JSON text as arguments": conversation(call=CALL | {"arguments": json.dumps({"command": "pwd"})}),
    "call with a list as arguments": conversation(call=CALL | {"arguments": ["pwd"]}),
    "call with NaN and little else": conversation(call='{"type":"tool_call","tool_name":"Nope","x":NaN}'),
    "call with NaN among its arguments": conversation(call=json.dumps(CALL | {"arguments": {"command": "pwd", "timeout": float("nan")}})),
    "call with a tool named twice": conversation(call='{"type":"tool_call","id":"call_1","tool_name":"Nope","tool_name":"Bash","arguments":{"command":"pwd"}}'),
    "call with a type named twice": conversation(call='{"type":"tool_call","type":"banana"}'),
    "call with a number as id": conversation(call=CALL | {"id": 1}, result=RESULT | {"tool_call_id": "1"}),
    "null links to null": conversation(call=CALL | {"id": None}, result=RESULT | {"tool_call_id": None}),
    "call without required argument": conversation(call=CALL | {"arguments": {"timeout": 3}}),
    "marks not replaced": conversation(call=CALL | {"id": ID_MARK}, result=RESULT | {"tool_call_id": ID_MARK}),
    "result is no JSON": conversation(result="x"),
    "result is a text": conversation(result='"x"'),
    "result of another type": conversation(result=RESULT | {"type": "other"}),
    "result without link": conversation(result=without(RESULT, "tool_call_id")),
    "result of another call": conversation(result=RESULT | {"tool_call_id": "call_2"}),
    "output is no JSON": conversation(result=RESULT | {"output": "plain"}),
    "output with placeholder": conversation(result=RESULT | {"output": '{"path": "{file_path}"}'}),
    "output that contradicts its exit code": conversation(result=RESULT | {"output": '{"exit_code": 0, "note": "Error in it"}'}),
    "output with text as exit code": conversation(result=RESULT | {"output": '{"exit_code": "0", "note": "error"}'}),
    "output that is an object": conversation(result=RESULT | {"output": {"stdout": "/"}}),
    "output named twice": conversation(result='{"type":"tool_result","tool_call_id":"call_1","output":"plain","output":"{}"}'),
    "answer with infinity beside it": conversation(final='{"type":"final_answer","content":"Bash ran pwd.","x":-Infinity}'),
    "answer without content": conversation(final=without(FINAL, "content")),
    "answer that is empty": conversation(final=FINAL | {"content": ""}),
    "answer that is null": conversation(final=FINAL | {"content": None}),
    "answer that is zero": conversation(final=FINAL | {"content": 0.0}),
    "answer that is minus zero": conversation(final='{"type": "final_answer", "content": -0}'),
    "answer that is the text 0": conversation(final=FINAL | {"content": "0"}),
    "answer that is the text false": conversation(final=FINAL | {"content": "false"}),
    "answer that is false": conversation(final=FINAL | {"content": False}),
    "answer that is an empty list": conversation(final=FINAL | {"content": []}),
    "answer that is an empty object": conversation(final=FINAL | {"content": {}}),
    "answer that is vague": conversation(final=FINAL | {"content": " Done. "}),
    "answer with placeholder": conversation(final=FINAL | {"content": "Bash has {count}"}),
    "answer that contradicts itself": conversation(final=FINAL | {"content": "Bash was a success, it failed."}),
    "answer without the tool": conversation(final=FINAL | {"content": "It ran pwd."}),
    "no user": conversation(roles=("system", "system", "assistant", "tool", "assistant")),
    "two calls, one result": [*conversation()[:3], ("assistant", json.dumps(CALL | {"id": "call_9", "tool_name": "Glob", "arguments": {"pattern": "*"}})), *conversation()[3:]],
}


def rows() -> list[tuple[str, int, str, str]]:
    return [(name, turn, role, content) for name, messages in CASES.items() for turn, (role, content) in enumerate(messages)]


def over(conversations: DataFrame) -> DataFrame:
    """id and messages: each conversation (conv_id) with the messages of one case, by its id, and its own number in the id."""
    spark = conversations.sparkSession
    numbered = spark.createDataFrame([(k, name, [(role, content, None, None) for role, content in messages]) for k, (name, messages) in enumerate(CASES.items())], f"k int, name string, messages {MESSAGE.simpleString()}")
    ids = conversations.select("conv_id").distinct().withColumn("k", F.pmod("conv_id", F.lit(len(CASES))).cast("int"))
    return ids.join(F.broadcast(numbered), "k").select(F.concat_ws(" ", "conv_id", "name").alias("id"), "messages")


def trajectories(spark: SparkSession) -> DataFrame:
    """id and messages of the cases."""
    table = [(name, [(role, content, None, None) for role, content in messages]) for name, messages in CASES.items()]
    return spark.createDataFrame(table, f"id string, messages {MESSAGE.simpleString()}")
