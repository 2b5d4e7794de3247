"""Registered queries of whole records: validation and review of cases, rendering, schemas, reports, JSON Lines, streams; with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomline.operators import render, report, validate
from loomline.plans import cases, generate
from loomline.plans.queries import ROWS, SEED, _t, _tool_sql, _u, diverse_sql, intent_rows, query, row_ids, rules_sql
from loomline.sources import dimensions, jsonl
from loomline.streaming import validator

STAMP = "2026-01-01T00:00:00.000000+00:00"


def _text(value: object) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_text(v) for v in row) + ")" for row in rows)


_NAMES = ", ".join(f"'{t}'" for t in dimensions.TOOL_NAMES)


def parsed_sql(messages: str) -> str:
    """CTEs over messages (id, turn, role, content): cases (id, n) and m, what each message holds; of repeated keys the last."""
    return f"""messages AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY turn) - 1 AS place FROM ({messages})), cases AS (SELECT id, count(*) AS n FROM messages GROUP BY id),
p AS (SELECT *, role IN ('assistant', 'tool') AND coalesce(json_valid(content), false) AS ok FROM messages),
o AS (SELECT *, ok AND json_type(CASE WHEN ok THEN content END) = 'OBJECT' AS obj FROM p),
j AS (SELECT id, turn, place, role, content, ok, obj, CASE WHEN obj THEN content END AS c FROM o),
e AS (SELECT j.id, place, key, arg_max(value, e.id) AS value, arg_max(type, e.id) AS kind FROM j, json_each(j.c) e GROUP BY ALL),
t AS (SELECT *, CASE WHEN kind <> 'NULL' THEN json_extract_string(value, '$') END AS text FROM e),
k AS (SELECT id, place, list(key) AS keys, max(text) FILTER (key = 'type' AND kind = 'VARCHAR') AS type, max(value::VARCHAR) FILTER (key = 'id') AS call_key, max(text) FILTER (key = 'id') AS call_id, max(text) FILTER (key = 'tool_name') AS tool_name,
 max(kind) FILTER (key = 'arguments') AS args_type, max(json_keys(value)) FILTER (key = 'arguments' AND kind = 'OBJECT') AS args, max(value::VARCHAR) FILTER (key = 'tool_call_id') AS tcid_key, max(text) FILTER (key = 'tool_call_id') AS tcid,
 max(text) FILTER (key = 'output') AS output, max(text) FILTER (key = 'content') AS answer, max(kind) FILTER (key = 'content') AS answer_type, max(json_array_length(value)) FILTER (key = 'content' AND kind = 'ARRAY') AS answer_length,
 max(len(json_keys(value))) FILTER (key = 'content' AND kind = 'OBJECT') AS answer_keys FROM t GROUP BY id, place),
m AS (SELECT j.id, j.turn, j.place, role, content, ok, obj, coalesce(keys, []) AS keys, k.* EXCLUDE (id, place, keys) FROM j LEFT JOIN k ON k.id IS NOT DISTINCT FROM j.id AND k.place = j.place)"""


def issues_sql(messages: str) -> str:
    """parsed_sql() and f (id, place, turn, k, issue): the validator's errors, without those of short conversations."""
    return f"""{parsed_sql(messages)},
a AS (SELECT id, turn, place, role, ok, obj, keys, type, tool_name, role = 'assistant' AND obj AND coalesce(type = 'tool_call', false) AS call,
 role = 'assistant' AND obj AND coalesce(type = 'final_answer', false) AS final,
 NOT coalesce(list_contains(keys, 'content'), false) OR answer_type = 'NULL' OR (answer_type = 'VARCHAR' AND answer = '') OR (answer_type = 'BOOLEAN' AND answer = 'false')
 OR (answer_type IN ('BIGINT', 'UBIGINT', 'DOUBLE') AND TRY_CAST(answer AS DOUBLE) = 0) OR (answer_type = 'ARRAY' AND answer_length = 0) OR (answer_type = 'OBJECT' AND answer_keys = 0) AS falsy FROM m),
f AS (
 SELECT id, place, turn, 0 AS k, 'assistant message not valid JSON' AS issue FROM a WHERE role = 'assistant' AND NOT ok
 UNION ALL SELECT id, place, turn, 1, 'ASSISTANT_NOT_OBJECT' FROM a WHERE role = 'assistant' AND ok AND NOT obj
 UNION ALL SELECT id, place, turn, 2, 'tool_call missing id' FROM a WHERE call AND NOT list_contains(keys, 'id')
 UNION ALL SELECT id, place, turn, 3, 'unknown tool: ' || coalesce(tool_name, 'None') FROM a WHERE call AND NOT coalesce(tool_name IN ({_NAMES}), false)
 UNION ALL SELECT id, place, turn, 4, 'tool_call missing arguments' FROM a WHERE call AND NOT list_contains(keys, 'arguments')
 UNION ALL SELECT id, place, turn, 5, 'final_answer missing content' FROM a WHERE final AND falsy
 UNION ALL SELECT id, place, turn, 6, 'tool message not valid JSON' FROM a WHERE role = 'tool' AND NOT ok
 UNION ALL SELECT id, place, turn, 7, 'TOOL_NOT_OBJECT' FROM a WHERE role = 'tool' AND ok AND NOT obj
 UNION ALL SELECT id, place, turn, 8, 'tool message must have type=tool_result' FROM a WHERE role = 'tool' AND obj AND type IS DISTINCT FROM 'tool_result'
 UNION ALL SELECT id, place, turn, 9, 'tool_result missing tool_call_id' FROM a WHERE role = 'tool' AND obj AND NOT list_contains(keys, 'tool_call_id')
 UNION ALL SELECT id, -3, NULL, 0, 'first message must be system' FROM messages WHERE place = 0 AND role <> 'system'
 UNION ALL SELECT id, -2, NULL, 0, 'second message must be user' FROM messages WHERE place = 1 AND role <> 'user'
 UNION ALL SELECT id, -1, NULL, 0, 'last message must be assistant' FROM messages JOIN cases USING (id) WHERE place = n - 1 AND role <> 'assistant')"""


_NUMBERED = f"SELECT DISTINCT conv_id || ' ' || name AS id, name FROM conversations JOIN (VALUES {_values(enumerate(cases.CASES))}) c(k, name) ON k = conv_id % {len(cases.CASES)}"
_MESSAGES_OF_CASES = f"SELECT n.id, turn, role, content FROM ({_NUMBERED}) n JOIN (VALUES {_values(cases.rows())}) v(name, turn, role, content) USING (name)"
_EMPTY = ", ".join(f"'{name}'" for name, m in cases.CASES.items() if not m)
_ISSUES = f"""{issues_sql(_MESSAGES_OF_CASES)}, known AS (SELECT * FROM cases UNION ALL SELECT id, 0 FROM ({_NUMBERED}) WHERE name IN ({_EMPTY})),
i AS (SELECT known.id, n, CASE WHEN n < 4 THEN 'too few messages' ELSE coalesce(string_agg(issue, '; ' ORDER BY place, k), '') END AS issues FROM known LEFT JOIN f USING (id) GROUP BY known.id, n)"""


def _cases(spark, sf_dir):
    return cases.over(_t(spark, sf_dir, "conversations"))


@query(f"WITH {_ISSUES} SELECT id, issues FROM i")
def validator_cases(spark, sf_dir):
    return validate.structural_issues(_cases(spark, sf_dir)).select("id", F.array_join("issues", "; ").alias("issues"))


@query(f"WITH {_ISSUES} SELECT count(*) AS total, count(*) FILTER (issues = '') AS valid, count(*) FILTER (issues <> '') AS invalid FROM i")
def validator_batch_stats(spark, sf_dir):
    return validate.batch_stats(validate.structural_issues(_cases(spark, sf_dir)))


@query(f"WITH {_ISSUES} SELECT id, n AS n_messages FROM i WHERE issues = ''")
def valid_cases_only(spark, sf_dir):
    return validate.valid_only(_cases(spark, sf_dir)).select("id", F.size("messages").alias("n_messages"))


_REQUIRED = _values((name, a) for name, _, _, _, args in dimensions.TOOLS for a, _, r in args if r)
_BOTH = " OR ".join(f"(contains(lower(answer), '{a}') AND contains(lower(answer), '{b}'))" for a, b in validate.CONTRADICTIONS)
_VAGUE = ", ".join(f"'{v}'" for v in validate.VAGUE)


def codes_sql(messages: str) -> str:
    """The review codes of messages (id, turn, role, content): id, turn, code, category."""
    return f"""WITH {parsed_sql(messages)}, required(tool_name, arg) AS (VALUES {_REQUIRED}),
x AS (SELECT *, role = 'assistant' AND obj AND coalesce(type = 'tool_call', false) AS call, role = 'tool' AND obj AND coalesce(type = 'tool_result', false) AS result,
 role = 'assistant' AND obj AND coalesce(type = 'final_answer', false) AS final, list_contains(keys, 'id') AS has_id, list_contains(keys, 'tool_name') AS has_tool FROM m),
calls AS (SELECT id, call_key, tool_name FROM x WHERE call),
named AS (SELECT DISTINCT id FROM calls WHERE tool_name IS NOT NULL),
s AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY turn) AS k, row_number() OVER (PARTITION BY id ORDER BY turn DESC) AS back, lag(role) OVER (PARTITION BY id ORDER BY turn) AS before FROM x WHERE role <> 'system')
SELECT id, turn, 'TC_MISSING_ID' AS code, 'SCHEMA' AS category FROM x WHERE call AND NOT has_id
UNION ALL SELECT id, turn, 'TC_MISSING_TOOL', 'SCHEMA' FROM x WHERE call AND NOT has_tool
UNION ALL SELECT id, turn, 'TC_BAD_ARGS', 'SCHEMA' FROM x WHERE call AND args_type IS DISTINCT FROM 'OBJECT'
UNION ALL SELECT id, turn, 'TR_MISSING_TCID', 'SCHEMA' FROM x WHERE result AND NOT list_contains(keys, 'tool_call_id')
UNION ALL SELECT id, turn, 'FA_MISSING_CONTENT', 'SCHEMA' FROM x WHERE final AND NOT list_contains(keys, 'content')
UNION ALL SELECT id, turn, 'UNKNOWN_TOOL', 'TOOL_CALL' FROM x WHERE call AND has_tool AND NOT coalesce(tool_name IN ({_NAMES}), false)
UNION ALL SELECT DISTINCT id, turn, 'MISSING_ARG', 'TOOL_CALL' FROM x JOIN required USING (tool_name) WHERE call AND NOT (args_type IS NOT DISTINCT FROM 'OBJECT' AND list_contains(args, arg))
UNION ALL SELECT id, turn, 'EMPTY_ID', 'TOOL_CALL' FROM x WHERE call AND has_id AND trim(coalesce(call_id, '')) = ''
UNION ALL SELECT id, turn, 'UNSUBSTITUTED_ID', 'TOOL_CALL' FROM x WHERE call AND call_id = '{validate.ID_MARK}'
UNION ALL SELECT id, turn, 'UNSUBSTITUTED_TCID', 'TOOL_RESULT' FROM x WHERE result AND tcid = '{validate.ID_MARK}'
UNION ALL SELECT id, turn, 'TCID_MISMATCH', 'TOOL_RESULT' FROM x WHERE result AND NOT EXISTS (SELECT 1 FROM calls WHERE calls.id = x.id AND coalesce(calls.call_key, 'null') = x.tcid_key)
UNION ALL SELECT id, turn, 'OUTPUT_NOT_JSON', 'TOOL_RESULT' FROM x WHERE result AND NOT coalesce(json_valid(output), false)
UNION ALL SELECT id, turn, 'OUTPUT_PLACEHOLDER', 'TOOL_RESULT' FROM x WHERE result AND regexp_matches(output, '{validate.PLACEHOLDER}')
UNION ALL SELECT id, turn, 'EXIT_CODE_CONFLICT', 'TOOL_RESULT' FROM x WHERE result AND json_type(CASE WHEN json_valid(output) THEN output END, '$.exit_code') IN ('BIGINT', 'UBIGINT', 'DOUBLE')
 AND TRY_CAST(json_extract_string(CASE WHEN json_valid(output) THEN output END, '$.exit_code') AS DOUBLE) = 0 AND contains(lower(output), 'error')
UNION ALL SELECT id, turn, 'VAGUE_ANSWER', 'FINAL_ANSWER' FROM x WHERE final AND trim(lower(answer)) IN ({_VAGUE})
UNION ALL SELECT id, turn, 'ANSWER_PLACEHOLDER', 'FINAL_ANSWER' FROM x WHERE final AND regexp_matches(answer, '{validate.PLACEHOLDER}')
UNION ALL SELECT id, turn, 'HALLUCINATION', 'FINAL_ANSWER' FROM x WHERE final AND ({_BOTH})
UNION ALL SELECT id, turn, 'NOT_GROUNDED', 'FINAL_ANSWER' FROM x WHERE final AND id IN (SELECT id FROM named) AND NOT EXISTS (SELECT 1 FROM calls WHERE calls.id = x.id AND contains(coalesce(x.answer, ''), calls.tool_name))
UNION ALL SELECT id, NULL, 'BAD_FIRST_ROLE', 'SEQUENCE' FROM s WHERE k = 1 AND role <> 'user'
UNION ALL SELECT id, NULL, 'BAD_LAST_ROLE', 'SEQUENCE' FROM s WHERE back = 1 AND role <> 'assistant'
UNION ALL SELECT id, NULL, 'COUNT_MISMATCH', 'SEQUENCE' FROM s GROUP BY id HAVING count(*) FILTER (call) <> count(*) FILTER (result)
UNION ALL SELECT DISTINCT id, NULL, 'BAD_ALTERNATION', 'SEQUENCE' FROM s WHERE role = before"""


@query(f"SELECT id, turn::INT AS turn, code, category FROM ({codes_sql(_MESSAGES_OF_CASES)})")
def critic_cases(spark, sf_dir):
    return validate.critique(_cases(spark, sf_dir))


_ARG = "json_extract_string(arguments, '$.{}')"


def _arg(name: str, default: str | None = None) -> str:
    return _ARG.format(name) if default is None else f"coalesce({_ARG.format(name)}, '{default}')"


_PATH, _FILE = _arg("file_path", "unknown"), _arg("file_path", "file")
_PREVIEW = f"array_to_string(list_slice(['# ' || {_PATH}, '', 'alpha', 'beta', 'gamma'], 1, least(coalesce(TRY_CAST({_arg('limit')} AS INT), 100), 5)), chr(10))"
_CONTENT = _arg("content", "")
_LINES = f"CASE WHEN {_CONTENT} = '' THEN 0 ELSE len(string_split({_CONTENT}, chr(10))) - ends_with({_CONTENT}, chr(10))::INT END"
_REPLACED = f"CASE WHEN {_arg('old_string', '')} <> '' THEN 1 ELSE 0 END"
_OUTPUT = f"""CASE tool_name
 WHEN 'Bash' THEN CASE WHEN rule = 'other' THEN json_object('stdout', 'Ran: ' || {_arg('command', '')} || chr(10), 'stderr', '', 'exit_code', 0)
  ELSE json_object('kind', rule, 'result', 'ok', 'total', CASE WHEN rule = 'find_py' THEN 3 ELSE 1 END) END
 WHEN 'File_Read' THEN json_object('path', {_PATH}, 'bytes_read', octet_length(encode({_PREVIEW})), 'lines_read', 5, 'content', {_PREVIEW})
 WHEN 'File_Write' THEN json_object('path', {_PATH}, 'bytes_written', octet_length(encode({_CONTENT})), 'lines_written', {_LINES}, 'append', {_arg('append', 'false')} = 'true')
 WHEN 'File_Edit' THEN json_object('path', {_PATH}, 'replacements', {_REPLACED}, 'old_string', {_arg('old_string', '')}, 'new_string', {_arg('new_string', '')})
 WHEN 'Glob' THEN json_object('pattern', {_arg('pattern', '*')}, 'matches', ['lib/a.py', 'lib/b.py', 'tests/test_a.py'], 'total', 3)
 WHEN 'Grep' THEN json_object('matches', ['lib/a.py:7:' || {_arg('pattern', '')}, 'lib/b.py:9:' || {_arg('pattern', '')}], 'total', 2, 'pattern', {_arg('pattern', '')}, 'path', {_arg('path', '.')})
 WHEN 'TodoWrite' THEN json_object('todo', {_arg('todo', '')}, 'status', {_arg('status', 'pending')}, 'updated', true)
 WHEN 'TodoRead' THEN json_object('todos', [json_object('id', '1', 'todo', 'plan', 'status', 'completed'), json_object('id', '2', 'todo', 'build', 'status', 'in_progress'), json_object('id', '3', 'todo', 'check', 'status', 'pending')])
 WHEN 'Web_Search' THEN json_object('results', ['About ' || {_arg('query', '')}, {_arg('query', '')} || ': notes', {_arg('query', '')} || ' in depth'], 'total', 3, 'query', {_arg('query', '')})
 ELSE json_object('url', {_arg('url', '')}, 'status', 200, 'content_length', 2048, 'content_type', 'text/html', 'content', 'page at ' || {_arg('url', '')}) END"""
_ANSWER = f"""CASE tool_name
 WHEN 'Bash' THEN {_arg('command', 'command')} || CASE WHEN success THEN ': finished.' ELSE ': failed.' END
 WHEN 'File_Read' THEN CASE WHEN success THEN 'File_Read read ' || {_FILE} || ': 10 lines, 256 bytes.' ELSE 'File_Read could not read ' || {_FILE} || '.' END
 WHEN 'File_Write' THEN CASE WHEN success THEN 'File_Write wrote ' || octet_length(encode({_CONTENT})) || ' bytes to ' || {_FILE} || '.' ELSE 'File_Write could not write ' || {_FILE} || '.' END
 WHEN 'File_Edit' THEN CASE WHEN success THEN 'File_Edit replaced ' || {_REPLACED} || ' in ' || {_FILE} || '.' ELSE 'File_Edit could not change ' || {_FILE} || '.' END
 WHEN 'Glob' THEN CASE WHEN success THEN 'Glob has 3 matches for ''' ELSE 'Glob has no match for ''' END || {_arg('pattern', '*')} || '''.'
 WHEN 'Grep' THEN CASE WHEN success THEN 'Grep has 2 matches for ''' ELSE 'Grep has no match for ''' END || {_arg('pattern', '')} || '''.'
 WHEN 'TodoWrite' THEN CASE WHEN success THEN 'TodoWrite set ''' || {_arg('todo', '')} || ''' to ' || {_arg('status', 'pending')} || '.' ELSE 'TodoWrite could not set ''' || {_arg('todo', '')} || '''.' END
 WHEN 'TodoRead' THEN CASE WHEN success THEN 'TodoRead lists 3 items.' ELSE 'TodoRead could not list items.' END
 WHEN 'Web_Search' THEN CASE WHEN success THEN 'Web_Search has 3 results for ''' ELSE 'Web_Search could not search ''' END || {_arg('query', '')} || '''.'
 ELSE CASE WHEN success THEN 'Web_Fetch loaded ' || {_arg('url', '')} || ' (HTTP 200).' ELSE 'Web_Fetch could not load ' || {_arg('url', '')} || '.' END END"""
_BULLETS = " || ".join(f"chr(10) || '  - {name}: {dimensions.DESCRIPTIONS[name]} ({', '.join(a[0] for a in args) or 'no arguments'})'" for name, _, _, _, args in dimensions.TOOLS)
_ABOUT = _values((name, category, cause) for name, category, _, cause, _ in dimensions.TOOLS)
_LOCALES = _values((i, *row) for i, row in enumerate(dimensions.LOCALES))
_MESSAGES = _values(dimensions.MESSAGES)
_MEDIUM = f"texts AS (SELECT kind, language, list(text ORDER BY idx) AS texts FROM (VALUES {_MESSAGES}) m(kind, difficulty, language, idx, text) WHERE difficulty = 'medium' GROUP BY kind, language)"
_RENDERED = f"""WITH {diverse_sql(intent_rows(repair=True))}, about(tool_name, category, cause) AS (VALUES {_ABOUT}), l(pos, language, tone, formality) AS (VALUES {_LOCALES}), {_MEDIUM},
r AS (SELECT id, tool_name, query, arguments, {rules_sql(_arg('command', ''))} AS rule, {_u('failure')} > 0.15::DOUBLE AS success, language, tone, formality, category, cause,
 'call_' || substr(md5('{SEED}|id|' || id), 1, 12) AS call_id FROM diverse JOIN about USING (tool_name) JOIN l ON l.pos = floor({_u('locale')} * {len(dimensions.LOCALES)})::INT),
c AS (SELECT r.*, texts[floor({_u('message')} * len(texts))::INT + 1] || CASE WHEN success THEN '' ELSE 'failed' END AS closing
 FROM r JOIN texts ON texts.language = r.language AND texts.kind = CASE WHEN success THEN 'success' ELSE 'error' END)"""


@query(f"""{_RENDERED} SELECT id, tool_name, success,
 md5('You are a command-line assistant with 10 tools. Language: ' || language || ', tone: ' || tone || ', formality: ' || formality || '. Call a tool when one fits.' || chr(10) || 'Tools:' || {_BULLETS}) AS prompt,
 query AS user_text, call_id, call_id AS result_id, tool_name AS result_name, arguments AS call_arguments,
 CASE WHEN success THEN {_OUTPUT} ELSE json_object('error', cause, 'exit_code', 1) END::VARCHAR AS output, {_ANSWER} || ' ' || closing AS answer,
 language, category, 1 AS num_tools, 'system user assistant tool assistant' AS roles FROM c""")
def gen_rendered_messages(spark, sf_dir):
    made = generate.bulk(spark, row_ids(spark, sf_dir), repair=True, generated_at=STAMP)
    m = lambda i, path: F.get_json_object(F.get("messages", F.lit(i))["content"], path)
    return made.select(
        "id", F.col("metadata.tool_name").alias("tool_name"), F.col("metadata.success").alias("success"), F.md5(F.get("messages", F.lit(0))["content"].cast("binary")).alias("prompt"), F.get("messages", F.lit(1))["content"].alias("user_text"),
        m(2, "$.id").alias("call_id"), m(3, "$.tool_call_id").alias("result_id"), F.get("messages", F.lit(3))["name"].alias("result_name"), m(2, "$.arguments").alias("call_arguments"), m(3, "$.output").alias("output"), m(4, "$.content").alias("answer"),
        F.col("localization.language").alias("language"), F.col("metadata.tool_category").alias("category"), F.col("metadata.num_tools").alias("num_tools"), F.array_join(F.transform("messages", lambda x: x["role"]), " ").alias("roles"),
    )


@query(f"""WITH {diverse_sql(intent_rows())} SELECT count(*) AS total, count(*) FILTER (json_valid(arguments) AND tool_name IN ({_NAMES})) AS valid, count(*) FILTER (NOT json_valid(arguments) OR tool_name NOT IN ({_NAMES})) AS invalid FROM diverse""")
def gen_trajectories_valid(spark, sf_dir):
    return validate.batch_stats(validate.structural_issues(generate.bulk_unchecked(spark, row_ids(spark, sf_dir))))


@query(f"""WITH required(tool_name, arg) AS (VALUES {_REQUIRED}), {diverse_sql(intent_rows())},
x AS (SELECT id, 'MISSING_ARG' AS code, 'TOOL_CALL' AS category FROM diverse JOIN required USING (tool_name) WHERE NOT list_contains(json_keys(arguments), arg) GROUP BY id
 UNION ALL SELECT id, 'NOT_GROUNDED', 'FINAL_ANSWER' FROM diverse WHERE tool_name = 'Bash' AND NOT contains(json_extract_string(arguments, '$.command'), 'Bash'))
SELECT code, category, count(*) AS n FROM x GROUP BY code, category""")
def gen_critic_issue_counts(spark, sf_dir):
    return validate.critique(generate.bulk_unchecked(spark, row_ids(spark, sf_dir))).groupBy("code", "category").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH i(tool_name, idx, query, arguments) AS (VALUES {_values(dimensions.LIBRARY_INTENTS)}), n AS (SELECT tool_name, count(*) AS n FROM i GROUP BY 1),
d AS (SELECT id, {_tool_sql()} AS tool_name FROM {ROWS}), e AS (SELECT d.*, floor({_u('intent')} * n)::INT AS idx FROM d LEFT JOIN n USING (tool_name))
SELECT e.id, e.tool_name, coalesce(i.query, 'use ' || e.tool_name) AS query, coalesce(i.arguments, '{{}}') AS arguments FROM e LEFT JOIN i ON i.tool_name = e.tool_name AND i.idx = e.idx""")
def gen_library_intents(spark, sf_dir):
    made = generate.library_batch(spark, row_ids(spark, sf_dir), generated_at=STAMP)
    return made.select("id", F.col("metadata.tool_name").alias("tool_name"), F.get("messages", F.lit(1))["content"].alias("query"), F.get_json_object(F.get("messages", F.lit(2))["content"], "$.arguments").alias("arguments"))


@query(f"""WITH m(kind, difficulty, language, idx, text) AS (VALUES {_MESSAGES}),
g AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'easy' WHEN 1 THEN 'medium' WHEN 2 THEN 'hard' WHEN 3 THEN 'expert' END AS difficulty, CASE doc_id % 7 WHEN 5 THEN 'xx' WHEN 6 THEN NULL ELSE lang END AS language FROM documents)
SELECT doc_id, g.difficulty, g.language, string_agg(text, '|' ORDER BY idx) FILTER (kind = 'success') AS done, string_agg(text, '|' ORDER BY idx) FILTER (kind = 'error') AS failed FROM g
JOIN m ON m.difficulty = CASE WHEN g.difficulty IN ('easy', 'medium', 'hard') THEN g.difficulty ELSE 'easy' END
 AND m.language = CASE WHEN g.language IN (SELECT language FROM m) THEN g.language ELSE 'en' END GROUP BY doc_id, g.difficulty, g.language""")
def message_fallbacks(spark, sf_dir):
    """The closing sentences for each document, by its language and a difficulty of its number; some have none of either that is known."""
    level = F.get(F.array(*[F.lit(d) for d in ("easy", "medium", "hard", "expert", None)]), (F.col("doc_id") % 5).cast("int"))
    language = F.when(F.col("doc_id") % 7 == 5, "xx").when(F.col("doc_id") % 7 < 5, F.col("lang"))
    rows = _t(spark, sf_dir, "documents").select("doc_id", level.alias("difficulty"), language.alias("language"))
    met = render.message_texts(rows, F.col("difficulty"), F.col("language"), "done", "failed")
    return met.select("doc_id", "difficulty", "language", F.array_join("done", "|").alias("done"), F.array_join("failed", "|").alias("failed"))


@query(f"""WITH a(tool_name, description, position, argument, type, argument_description, required) AS (VALUES {_values((name, dimensions.DESCRIPTIONS[name], i, a, t, dimensions.ARGUMENT_DESCRIPTIONS[a], int(r)) for name, _, _, _, args in dimensions.TOOLS for i, (a, t, r) in enumerate(args))})
SELECT tool_name, description, position, argument, type, argument_description, required = 1 AS required, count(*) FILTER (required = 1) OVER (PARTITION BY tool_name) AS n_required, n_calls
FROM a JOIN (SELECT {_tool_sql()} AS tool_name, count(*) AS n_calls FROM {ROWS} GROUP BY 1) USING (tool_name)""")
def tool_function_schemas(spark, sf_dir):
    """The function schemas of the tools that the rows draw, argument by argument, with how often they do."""
    calls = generate.bulk_draws(spark, row_ids(spark, sf_dir)).groupBy("tool_name").agg(F.count(F.lit(1)).alias("n_calls"))
    made = jsonl.wire_tools(spark)
    f = spark.range(1).select(F.explode(made).alias("s")).select("s.function.*")
    rows = f.select(F.col("name").alias("tool_name"), "description", F.col("parameters.required").alias("r"), F.posexplode("parameters.properties").alias("position", "argument", "p"))
    return rows.select("tool_name", "description", "position", "argument", F.col("p.type").alias("type"), F.col("p.description").alias("argument_description"), F.array_contains("r", F.col("argument")).alias("required"), F.size("r").cast("long").alias("n_required")).join(F.broadcast(calls), "tool_name")


@query(f"SELECT DISTINCT {_tool_sql()} AS tool_name FROM {ROWS}")
def gen_distinct_tools(spark, sf_dir):
    return generate.bulk_draws(spark, row_ids(spark, sf_dir)).select("tool_name").distinct()


@query("""WITH x AS (SELECT doc_id AS id, lang AS language, source AS tool_name, coalesce(quality::VARCHAR, '?') AS difficulty FROM documents LEFT JOIN labels USING (doc_id)),
y AS (SELECT id, 'language' AS dimension, language AS value FROM x UNION ALL SELECT id, 'tool_name', tool_name FROM x UNION ALL SELECT id, 'difficulty', difficulty FROM x),
c AS (SELECT dimension, coalesce(value, '?') AS value, count(*) AS n, min(id) AS f FROM y GROUP BY 1, 2),
p AS (SELECT *, n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY dimension) AS pct, CASE WHEN dimension = 'difficulty' THEN row_number() OVER (PARTITION BY dimension ORDER BY value) ELSE row_number() OVER (PARTITION BY dimension ORDER BY n DESC, f) END AS place,
 CASE dimension WHEN 'tool_name' THEN 15 WHEN 'difficulty' THEN 10 ELSE 5 END AS wide FROM c)
SELECT dimension, place, value || repeat(' ', greatest(0, wide - length(value))) || ': ' || printf('%6d (%5.1f%%)', n, pct) || CASE WHEN dimension = 'tool_name' THEN ' ' || repeat('█', floor(pct / 2)::INT) ELSE '' END AS line FROM p WHERE dimension <> 'language' OR place <= 8""")
def report_console_lines(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left").select(F.lit("documents").alias("dataset"), F.col("doc_id").alias("id"), F.col("lang").alias("language"), F.col("source").alias("tool_name"), F.col("quality").alias("difficulty"))
    return report.console(report.distribution(rows, ["language", "tool_name", "difficulty"])).select("dimension", "place", "line")


def _as_records(spark, sf_dir, keep: str | None = None):
    """conversations as records without localization and metadata; keep: one column more."""
    turn = F.struct("turn", "role", F.col("text").alias("content"), F.when(F.col("role") == "tool", "x").otherwise("").alias("tool_call_id"), F.lit(None).cast("string").alias("name"))
    rows = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    messages = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"), x["tool_call_id"].alias("tool_call_id"), x["name"].alias("name")))
    return rows.select(messages.alias("messages"), F.lit(None).cast(jsonl.LOCALE).alias("localization"), F.lit(None).cast(jsonl.METADATA).alias("metadata"), *([keep] if keep else []))


@query("""SELECT turn, role, count(*) AS n, sum(octet_length(encode(text)))::BIGINT AS n_bytes, 0::BIGINT AS with_call_id, 10 AS n_tools FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn_ FROM conversations) GROUP BY turn, role""")
def conv_jsonl_round_trip(spark, sf_dir):
    path = jsonl.scratch_dir(spark)
    jsonl.write(_as_records(spark, sf_dir), path)
    rows = jsonl.read(spark, path).select(F.size("tools").alias("n_tools"), F.posexplode("messages").alias("turn", "m"))
    return rows.groupBy(F.col("turn").cast("long").alias("turn"), F.col("m.role").alias("role")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("m.content").cast("long")).alias("n_bytes"), F.count("m.tool_call_id").alias("with_call_id"), F.max("n_tools").alias("n_tools"))


@query("SELECT conv_id, role || ': ' || text AS line, turn FROM conversations")
def conv_training_lines(spark, sf_dir):
    turn = F.struct("turn", "role", F.col("text").alias("content"))
    rows = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("messages"))
    turns = F.col("messages")["turn"]
    made = rows.select("conv_id", turns.alias("turns"), jsonl.training_messages(F.col("messages")).alias("messages"))
    return made.select("conv_id", F.explode(F.arrays_zip("turns", "messages")).alias("x")).select("conv_id", F.concat(F.col("x.messages.role"), F.lit(": "), F.col("x.messages.content")).alias("line"), F.col("x.turns").alias("turn"))


@query("SELECT role, count(*) AS n FROM conversations WHERE role IN ('assistant', 'tool') AND NOT coalesce(json_valid(text) AND json_type(CASE WHEN json_valid(text) THEN text END) = 'OBJECT', false) GROUP BY role")
def stream_invalid_payloads(spark, sf_dir):
    path = jsonl.scratch_dir(spark)
    jsonl.write(_as_records(spark, sf_dir), f"{path}/in")
    validator.run_available(validator.invalid_payloads(spark, f"{path}/in"), f"{path}/out", f"{path}/state")
    return spark.read.parquet(f"{path}/out").groupBy("role").agg(F.count(F.lit(1)).alias("n"))
