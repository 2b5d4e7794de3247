"""Queries of the validator, the critic and JSON text over conversations and documents of any length, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.json_text import dumps_text
from loomline.operators import validate
from loomline.operators.render import MESSAGE
from loomline.plans.queries import _t, query
from loomline.plans.record_queries import codes_sql, issues_sql

#: What becomes of an assistant's turn by the first hex digit of a hash: forms of the tool call, of its result and of the answer, which holds the turn's
#: text; {} is the call's id. All other digits give the last form.
CALLS = {
    "0": '{"type":"tool_call","tool_name":"Nope","x":NaN}',
    "1": '{"type":"tool_call","id":"{}","tool_name":"Bash","arguments":{"command":"pwd","timeout":NaN}}',
    "2": '{"type":"tool_call","id":"{}","tool_name":"Nope","tool_name":"Bash","arguments":{"command":"pwd"}}',
    "3": '{"type":"tool_call","id":"{}","tool_name":"Bash","arguments":"{\\"command\\":\\"pwd\\"}"}',
    "4": "{'type':'tool_call','id':'{}','tool_name':'Bash','arguments':{}}",
    "5": '{"type":"tool_call","id":"{}","tool_name":"Bash","arguments":{"command":"pwd"}} and more',
    "6": '{"type":"tool_call","id":"{}","arguments":{"command":"pwd"}}',
    "7": "[1]",
    "": '{"type":"tool_call","id":"{}","tool_name":"Bash","arguments":{"command":"pwd"}}',
}
RESULTS = {
    "8": '{"type":"tool_result","output":"{}"}',
    "9": '{"type":"tool_result","tool_call_id":"call_0","output":"{}"}',
    "a": '{"type":"tool_result","tool_call_id":"{}","output":"plain"}',
    "b": '{"type":"tool_result","tool_call_id":"{}","output":"{\\"exit_code\\": 0, \\"note\\": \\"Error\\"}"}',
    "": '{"type":"tool_result","tool_call_id":"{}","output":"{\\"stdout\\": \\"/\\"}"}',
}
ANSWERS = {"c": '""', "d": '"Done."', "e": "null", "": None}


def _forms(forms: dict[str, str], digit: Column, call_id: Column) -> Column:
    at = lambda text: F.replace(F.lit(text), F.lit('"{}"'), F.concat(F.lit('"'), call_id, F.lit('"')))
    out = None
    for d, text in forms.items():
        out = (F.when(digit == d, at(text)) if out is None else out.when(digit == d, at(text))) if d else out.otherwise(at(text))
    return out


def payload_turns(conversations: DataFrame) -> DataFrame:
    """id, turn, role, content: conversations in which each assistant's turn has become a tool call, its result and an answer, with the damages above."""
    digit = F.substring(F.md5(F.concat_ws("|", F.lit("payload"), "conv_id", "turn").cast("binary")), 1, 1)
    call_id = F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"))
    text = dumps_text(F.concat(F.lit("Bash: "), F.coalesce("text", F.lit(""))), ascii=False)
    said = F.when(digit == "c", ANSWERS["c"]).when(digit == "d", ANSWERS["d"]).when(digit == "e", ANSWERS["e"]).otherwise(text)
    answer = F.concat(F.lit('{"type":"final_answer","content":'), said, F.lit("}"))
    made = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(role).alias("role"), content.alias("content")) for i, (role, content) in enumerate((("assistant", _forms(CALLS, digit, call_id)), ("tool", _forms(RESULTS, digit, call_id)), ("assistant", answer)), 1)])
    own = F.array(F.struct(F.lit(0).alias("step"), "role", F.col("text").alias("content")))
    rows = conversations.select("conv_id", "turn", F.inline(F.when(F.col("role") == "assistant", made).otherwise(own)))
    return rows.select(F.col("conv_id").alias("id"), (F.col("turn") * 4 + F.col("step")).alias("turn"), "role", "content")


def _forms_sql(forms: dict[str, str]) -> str:
    at = lambda text: "replace('{}', '\"{{}}\"', '\"' || call_id || '\"')".format(text.replace("'", "''"))
    return "CASE d " + " ".join(f"WHEN '{d}' THEN {at(text)}" if d else f"ELSE {at(text)}" for d, text in forms.items()) + " END"


_TURNS = "SELECT conv_id AS id, turn, role, text AS content FROM conversations"
_PAYLOADS = f"""SELECT id, turn, role, content FROM (
 WITH h AS (SELECT *, substr(md5('payload|' || conv_id || '|' || turn), 1, 1) AS d, 'call_' || conv_id || '_' || turn AS call_id FROM conversations)
 SELECT conv_id AS id, turn * 4 AS turn, role, text AS content FROM h WHERE role IS DISTINCT FROM 'assistant'
 UNION ALL SELECT conv_id, turn * 4 + 1, 'assistant', {_forms_sql(CALLS)} FROM h WHERE role = 'assistant'
 UNION ALL SELECT conv_id, turn * 4 + 2, 'tool', {_forms_sql(RESULTS)} FROM h WHERE role = 'assistant'
 UNION ALL SELECT conv_id, turn * 4 + 3, 'assistant', '{{"type":"final_answer","content":' || CASE d WHEN 'c' THEN '""' WHEN 'd' THEN '"Done."' WHEN 'e' THEN 'null' ELSE to_json('Bash: ' || coalesce(text, ''))::VARCHAR END || '}}' FROM h WHERE role = 'assistant')"""


def _issue_rows(messages: str) -> str:
    return f"""WITH {issues_sql(messages)} SELECT id AS conv_id, turn, issue FROM f WHERE id IN (SELECT id FROM cases WHERE n >= 4)
UNION ALL SELECT id, NULL, 'too few messages' FROM cases WHERE n < 4"""


def _code_rows(messages: str) -> str:
    return f"SELECT id AS conv_id, turn, code, category FROM ({codes_sql(messages)})"


def _turns(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id"), "turn", "role", F.col("text").alias("content"))


def _payloads(spark, sf_dir) -> DataFrame:
    return payload_turns(_t(spark, sf_dir, "conversations"))


@query(_issue_rows(_TURNS))
def conv_structural_issues(spark, sf_dir):
    return validate.turn_issues(_turns(spark, sf_dir)).withColumnRenamed("id", "conv_id")


@query(_code_rows(_TURNS))
def conv_review_codes(spark, sf_dir):
    return validate.turn_codes(_turns(spark, sf_dir)).withColumnRenamed("id", "conv_id")


@query(_issue_rows(_PAYLOADS))
def conv_payload_issues(spark, sf_dir):
    return validate.turn_issues(_payloads(spark, sf_dir)).withColumnRenamed("id", "conv_id")


@query(_code_rows(_PAYLOADS))
def conv_payload_codes(spark, sf_dir):
    return validate.turn_codes(_payloads(spark, sf_dir)).withColumnRenamed("id", "conv_id")


def payload_records(turns: DataFrame) -> DataFrame:
    """id and messages of turns (id, turn, role, content), for conversations that fit a row."""
    turn = F.struct("turn", "role", "content")
    messages = F.transform(F.sort_array(F.collect_list(turn)), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"), F.lit(None).cast("string").alias("tool_call_id"), F.lit(None).cast("string").alias("name")))
    return turns.groupBy("id").agg(messages.cast(MESSAGE).alias("messages"))


@query(f"""WITH {issues_sql(_PAYLOADS)} SELECT cases.id AS conv_id, n AS n_messages, CASE WHEN n < 4 THEN 'too few messages' ELSE coalesce(string_agg(issue, '; ' ORDER BY f.place, k), '') END AS issues
FROM cases LEFT JOIN f USING (id) GROUP BY cases.id, n""")
def conv_record_issues(spark, sf_dir):
    records = payload_records(_payloads(spark, sf_dir))
    found = validate.structural_issues(records.select(F.struct("id", F.size("messages").cast("long").alias("n")).alias("id"), "messages"))
    return found.select(F.col("id.id").alias("conv_id"), F.col("id.n").alias("n_messages"), F.array_join("issues", "; ").alias("issues"))


@query(f"SELECT code, category, count(*) AS n, count(DISTINCT conv_id) AS n_conversations FROM ({_code_rows(_PAYLOADS)}) GROUP BY code, category")
def conv_record_code_counts(spark, sf_dir):
    found = validate.critique(payload_records(_payloads(spark, sf_dir)))
    return found.groupBy("code", "category").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_conversations"))


@query("""WITH x AS (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations WHERE role <> 'system')
SELECT conv_id, count(*) AS n, min_by(role, turn) AS first, max_by(role, turn) AS last, 0::BIGINT AS calls, 0::BIGINT AS results, count(*) FILTER (role = before) AS repeats FROM x GROUP BY conv_id""")
def conv_sequence_facts(spark, sf_dir):
    return validate.sequence_facts(_turns(spark, sf_dir)).withColumnRenamed("id", "conv_id")


def _json_sql(ascii: bool) -> str:
    high = "WHEN ord(c) = 127 OR ord(c) BETWEEN 128 AND 65535 THEN printf('\\u%04x', ord(c)) WHEN ord(c) > 65535 THEN printf('\\u%04x\\u%04x', 55296 + ((ord(c) - 65536) >> 10), 56320 + ((ord(c) - 65536) & 1023))" if ascii else ""
    short = " ".join(f"WHEN {n} THEN '{s}'" for n, s in ((34, '\\"'), (92, "\\\\"), (10, "\\n"), (13, "\\r"), (9, "\\t"), (8, "\\b"), (12, "\\f")))
    return f"""'"' || array_to_string(list_transform(string_split(text, ''), lambda c: CASE ord(c) {short} ELSE CASE WHEN ord(c) < 32 THEN printf('\\u%04x', ord(c)) {high} ELSE c END END), '') || '"'"""


@query(f"SELECT doc_id, sha256({_json_sql(True)}) AS ascii_sha256, sha256({_json_sql(False)}) AS plain_sha256 FROM documents")
def doc_json_texts(spark, sf_dir):
    digest = lambda ascii: F.sha2(dumps_text(F.col("text"), ascii), 256)
    return _t(spark, sf_dir, "documents").select("doc_id", digest(True).alias("ascii_sha256"), digest(False).alias("plain_sha256"))
