"""Structural validation and the issue-code critic for trajectories.

Each content is parsed once (functions.payload); what a message breaks by itself is told from that parse alone. There are two forms:

* whole records, a row with an array of messages each: the checks are higher-order functions over the array, no row meets another one, there is
  no shuffle, and rows need no unique id (structural_issues, critique);
* turns, a row each, for conversations of any length: sorted by ranges of (conversation, turn), so that a long conversation goes on through
  several tasks, and facts of a whole conversation go back to its turns part by part (turn_issues, turn_codes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.payload import ALL, VALIDATED, payload_of, payloads_of
from loomline.functions.slices import bounded_batches
from loomline.functions.tables import written
from loomline.operators.fold import running, to_rows
from loomline.sources import dimensions

ID_MARK = "{{TOOL_CALL_ID}}"
#: What names a row: those of these columns that it has.
NAMES = ("dataset", "id")
PLACES = ["first message must be system", "second message must be user", "last message must be assistant"]
TOO_FEW = "too few messages"


def strict_json(content: Column | str) -> Column:
    """`object` or `other` for what json.loads takes, null for what it rejects."""
    return payload_of(dimensions.TOOL_NAMES, ("json",))(content)["json"]


def _is(value: Column, want: str) -> Column:
    return F.coalesce(value == want, F.lit(False))


def _true(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def _any_of(tests: list[tuple[Column, Column | str]]) -> Column:
    """The texts of the tests that hold, in order."""
    return F.filter(F.array(*[F.when(test, text if isinstance(text, Column) else F.lit(text)) for test, text in tests]), lambda x: x.isNotNull())


def _has(p: Column, key: str) -> Column:
    return _true(F.array_contains(p["keys"], key))


def _looked_at(role: Column, content: Column) -> Column:
    return F.when(role.isin("assistant", "tool"), content)


def with_parsed(trajectories: DataFrame, fields: tuple[str, ...] = ALL) -> DataFrame:
    """trajectories with t: for each message its role and p, these fields of its content's payload (looked at for assistant and tool messages only)."""
    bounded_batches(trajectories.sparkSession)
    own = F.transform("messages", lambda m: _looked_at(m["role"], m["content"]))
    rows = trajectories.withColumn("payloads_", payloads_of(dimensions.TOOL_NAMES, fields)(own))
    return rows.withColumn("t", F.zip_with("messages", "payloads_", lambda m, p: F.struct(m["role"].alias("role"), p.alias("p")))).drop("payloads_")


def message_issues(role: Column, p: Column) -> Column:
    """The validator's errors of one message, in order. Assistant and tool messages whose JSON is no object are reported as such."""
    assistant, tool, an_object = _is(role, "assistant"), _is(role, "tool"), _is(p["json"], "object")
    call, final = assistant & _is(p["type"], "tool_call"), assistant & _is(p["type"], "final_answer")
    return _any_of(
        [
            (assistant & p["json"].isNull(), "assistant message not valid JSON"),
            (assistant & _is(p["json"], "other"), "ASSISTANT_NOT_OBJECT"),
            (call & ~_has(p, "id"), "tool_call missing id"),
            (call & ~_true(p["tool_known"]), F.concat(F.lit("unknown tool: "), F.coalesce(p["tool_name"], F.lit("None")))),
            (call & ~_has(p, "arguments"), "tool_call missing arguments"),
            (final & _true(p["answer_falsy"]), "final_answer missing content"),
            (tool & p["json"].isNull(), "tool message not valid JSON"),
            (tool & _is(p["json"], "other"), "TOOL_NOT_OBJECT"),
            (tool & an_object & ~_is(p["type"], "tool_result"), "tool message must have type=tool_result"),
            (tool & an_object & ~_has(p, "tool_call_id"), "tool_result missing tool_call_id"),
        ]
    )


def place_issues(first: Column, second: Column, last: Column) -> Column:
    return _any_of([(~_is(role, want), text) for role, want, text in zip((first, second, last), ("system", "user", "assistant"), PLACES, strict=True)])


def structural_issues(trajectories: DataFrame) -> DataFrame:
    """dataset and id (as far as there are any), issues (array, in message order): the validator's errors; fewer than four messages is the only error then."""
    m = F.col("messages")
    order = place_issues(F.get(m, F.lit(0))["role"], F.get(m, F.lit(1))["role"], F.try_element_at(m, F.lit(-1))["role"])
    few = F.coalesce(F.size("messages"), F.lit(0)) < 4
    issues = F.when(few, F.array(F.lit(TOO_FEW))).otherwise(F.concat(order, F.flatten(F.transform("t", lambda x: message_issues(x["role"], x["p"])))))
    return with_parsed(trajectories, VALIDATED).select(*[c for c in NAMES if c in trajectories.columns], issues.alias("issues"))


def valid_only(trajectories: DataFrame) -> DataFrame:
    """The trajectories without any issue, in their own columns."""
    # through a generator, as Spark moves the filter on issues below plain columns, and then makes the messages again each time that it names them
    trajectories = trajectories.select(F.inline_outer(F.array(F.struct(*trajectories.columns))))
    rows = trajectories.select(F.struct(*trajectories.columns).alias("row"), "messages")
    return structural_issues(rows.withColumn("id", F.col("row"))).where(F.size("issues") == 0).select("id.*")


def batch_stats(issues: DataFrame) -> DataFrame:
    valid = F.size("issues") == 0
    return issues.agg(F.count(F.lit(1)).alias("total"), F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid"))


# Our own choice of words, as none are specified.
VAGUE = ["done.", "ok.", "okay.", "all good.", "as requested.", "task complete."]
CONTRADICTIONS = [("success", "failed"), ("completed", "could not")]
PLACEHOLDER = "\\{[A-Za-z_]+\\}"


def is_call(role: Column, p: Column) -> Column:
    return _is(role, "assistant") & _is(p["type"], "tool_call")


def is_result(role: Column, p: Column) -> Column:
    return _is(role, "tool") & _is(p["type"], "tool_result")


def is_final(role: Column, p: Column) -> Column:
    return _is(role, "assistant") & _is(p["type"], "final_answer")


def message_tests(role: Column, p: Column) -> list[tuple[str, str, Column]]:
    """Category, code and test of the review codes that one message tells by itself."""
    call, result, final = is_call(role, p), is_result(role, p), is_final(role, p)
    required = F.create_map(*[x for name, _, _, _, args in dimensions.TOOLS for x in (F.lit(name), F.array(*[F.lit(a) for a, _, r in args if r]).cast("array<string>"))])
    answer = F.coalesce(p["answer"], F.lit(""))
    lower = F.lower(answer)
    both = F.lit(False)
    for a, b in CONTRADICTIONS:
        both = both | (lower.contains(a) & lower.contains(b))
    return [
        ("SCHEMA", "TC_MISSING_ID", call & ~_has(p, "id")),
        ("SCHEMA", "TC_MISSING_TOOL", call & ~_has(p, "tool_name")),
        ("SCHEMA", "TC_BAD_ARGS", call & ~_is(p["arguments_kind"], "object")),
        ("SCHEMA", "TR_MISSING_TCID", result & ~_has(p, "tool_call_id")),
        ("SCHEMA", "FA_MISSING_CONTENT", final & ~_has(p, "content")),
        ("TOOL_CALL", "UNKNOWN_TOOL", call & _has(p, "tool_name") & ~_true(p["tool_known"])),
        ("TOOL_CALL", "MISSING_ARG", call & _true(p["tool_known"]) & (F.size(F.array_except(required[p["tool_name"]], p["argument_names"])) > 0)),
        ("TOOL_CALL", "EMPTY_ID", call & _has(p, "id") & (F.trim(F.coalesce(p["id"], F.lit(""))) == "")),
        ("TOOL_CALL", "UNSUBSTITUTED_ID", call & (p["id"] == ID_MARK)),
        ("TOOL_RESULT", "UNSUBSTITUTED_TCID", result & (p["tool_call_id"] == ID_MARK)),
        ("TOOL_RESULT", "OUTPUT_NOT_JSON", result & p["output_json"].isNull()),
        ("TOOL_RESULT", "OUTPUT_PLACEHOLDER", result & p["output"].rlike(PLACEHOLDER)),
        ("TOOL_RESULT", "EXIT_CODE_CONFLICT", result & p["exit_zero"] & F.lower(p["output"]).contains("error")),
        ("FINAL_ANSWER", "VAGUE_ANSWER", final & F.trim(lower).isin(VAGUE)),
        ("FINAL_ANSWER", "ANSWER_PLACEHOLDER", final & answer.rlike(PLACEHOLDER)),
        ("FINAL_ANSWER", "HALLUCINATION", final & both),
    ]


def _found(tests: list[tuple[str, str, Column]], *more: Column) -> Column:
    """Structs of more, code and category, one for each test that holds."""
    found = [F.when(_true(test), F.struct(*more, F.lit(code).alias("code"), F.lit(category).alias("category"))) for category, code, test in tests]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def _ungrounded(answer: Column, tools: Column) -> Column:
    text = F.coalesce(answer, F.lit(""))
    return (F.size(tools) > 0) & ~F.exists(tools, lambda n: text.contains(n))


def sequence_tests(first: Column, last: Column, calls: Column, results: Column, repeats: Column) -> list[tuple[str, str, Column]]:
    """Category, code and test of a whole sequence's codes; first and last: the roles of the messages that aren't the system's."""
    return [("SEQUENCE", code, test) for code, test in (("BAD_FIRST_ROLE", ~_is(first, "user")), ("BAD_LAST_ROLE", ~_is(last, "assistant")), ("COUNT_MISMATCH", calls != results), ("BAD_ALTERNATION", repeats))]


CODES = "array<struct<turn: int, code: string, category: string>>"


def with_codes(trajectories: DataFrame) -> DataFrame:
    """trajectories with codes, an array of (turn, code, category): the 22 review codes, each time one applies (turn null: the whole sequence)."""
    rows = with_parsed(trajectories)
    call = lambda x: is_call(x["role"], x["p"])
    result = lambda x: is_result(x["role"], x["p"])
    calls = F.transform(F.filter("t", call), lambda x: x["p"]["id_key"])
    tools = F.filter(F.transform(F.filter("t", call), lambda x: x["p"]["tool_name"]), lambda n: n.isNotNull())
    roles = F.transform(F.filter("t", lambda x: ~_is(x["role"], "system")), lambda x: x["role"])
    rows = rows.withColumns({"calls_": calls, "tools_": tools, "roles_": roles})

    def of_message(x: Column, turn: Column) -> Column:
        role, p = x["role"], x["p"]
        whole = [
            ("TOOL_RESULT", "TCID_MISMATCH", is_result(role, p) & ~(_has(p, "tool_call_id") & _true(F.array_contains("calls_", p["tool_call_id_key"])))),
            ("FINAL_ANSWER", "NOT_GROUNDED", is_final(role, p) & _ungrounded(p["answer"], F.col("tools_"))),
        ]
        return _found(message_tests(role, p) + whole, turn.cast("int").alias("turn"))

    repeats = F.exists(F.sequence(F.lit(1), F.greatest(F.size("roles_") - 1, F.lit(1))), lambda i: _true(F.get("roles_", i) == F.get("roles_", i - 1)))
    tests = sequence_tests(F.get("roles_", F.lit(0)), F.try_element_at("roles_", F.lit(-1)), F.size(F.filter("t", call)), F.size(F.filter("t", result)), repeats)
    sequence = F.when(F.size("roles_") > 0, _found(tests, F.lit(None).cast("int").alias("turn"))).otherwise(F.array().cast(CODES))
    codes = F.concat(F.flatten(F.transform("t", of_message)), sequence)
    return rows.select(*trajectories.columns, F.coalesce(codes, F.array().cast(CODES)).alias("codes"))


def critique(trajectories: DataFrame) -> DataFrame:
    """dataset and id (as far as there are any), turn, code, category: a row each time a review code applies (turn null: the whole sequence)."""
    names = [c for c in NAMES if c in trajectories.columns]
    # explode_outer: of explode Spark makes a filter on the array's size, which evaluates the whole review a second time
    return with_codes(trajectories).select(*names, F.explode_outer("codes").alias("x")).where("x IS NOT NULL").select(*names, "x.*")


def _parsed_turns(turns: DataFrame, fields: tuple[str, ...] = ALL) -> DataFrame:
    """turns (id, turn, role, content) with these fields of the content's payload, p, in its place."""
    bounded_batches(turns.sparkSession)
    return turns.select("id", "turn", "role", _looked_at(F.col("role"), F.col("content")).alias("content")).withColumn("p", payload_of(dimensions.TOOL_NAMES, fields)(F.col("content"))).drop("content")


def _reviewed_turns(turns: DataFrame) -> DataFrame:
    """What the review needs of each turn, sorted by conversation with the system's messages first, with the role before and the part that it is in."""
    p, role = F.col("p"), F.col("role")
    own = _parsed_turns(turns).select(
        "id", "turn", "role", (~_is(role, "system")).alias("spoken"), _found(message_tests(role, p)).alias("codes"), is_call(role, p).alias("call"), is_result(role, p).alias("result"), is_final(role, p).alias("final"),
        p["id_key"].alias("call_key"), F.when(_has(p, "tool_call_id"), p["tool_call_id_key"]).alias("result_key"), p["tool_name"].alias("tool_name"), F.when(is_final(role, p), F.coalesce(p["answer"], F.lit(""))).alias("answer"),
    )
    # written first, as sorting by ranges looks at its input twice, and contents are to be parsed once
    return running(written(own, "parsed"), ["id"], ["spoken", "turn"], before={"before": F.struct("role", "spoken")}, part="part")


def _sequence_facts(rows: DataFrame) -> DataFrame:
    spoken = F.col("spoken")
    again = spoken & F.col("before.spoken") & (F.col("role") == F.col("before.role"))
    return rows.groupBy("id").agg(
        F.count_if(spoken).alias("n"), F.min_by("role", F.when(spoken, F.col("turn"))).alias("first"), F.max_by("role", F.when(spoken, F.col("turn"))).alias("last"),
        F.count_if("call").alias("calls"), F.count_if("result").alias("results"), F.count_if(_true(again)).alias("repeats"),
    )


def sequence_facts(turns: DataFrame) -> DataFrame:
    """id, n, first, last, calls, results, repeats of conversations given as turns (id, turn, role, content): how many messages aren't the system's, the roles of the first
    and the last of these, tool calls, tool results, and messages of the role of the one before; of any length."""
    return _sequence_facts(_reviewed_turns(turns))


def turn_issues(turns: DataFrame) -> DataFrame:
    """id, turn, issue of conversations given as turns (id, turn, role, content), in any order: what structural_issues() says of records.

    turn is null for what concerns the whole conversation. Turns of one conversation are told apart by turn; a null id is an id like others. No conversation is
    gathered in one task. An empty table gives an empty result.
    """
    own = _parsed_turns(turns, VALIDATED).select("id", "turn", "role", message_issues(F.col("role"), F.col("p")).alias("issues"))
    rows = running(written(own, "parsed"), ["id"], ["turn"], sums={"place": F.lit(1)}, part="part")
    at = lambda k: F.max(F.when(F.col("place") == k, F.col("role")))
    facts = rows.groupBy("id").agg(F.max("place").alias("n"), at(1).alias("first"), at(2).alias("second"), F.max_by("role", "place").alias("last"))
    whole = F.when(F.col("n") < 4, F.array(F.lit(TOO_FEW))).otherwise(place_issues(F.col("first"), F.col("second"), F.col("last")))
    of_all = facts.select("id", F.lit(None).cast("long").alias("turn"), F.explode(whole).alias("issue"))
    some = rows.where(F.size("issues") > 0).select("id", "turn", "part", "issues")
    met = to_rows(some, facts.select("id", "n"), ["id"], "part")
    return of_all.unionByName(met.where("n >= 4").select("id", F.col("turn").cast("long").alias("turn"), F.explode("issues").alias("issue")))


def turn_codes(turns: DataFrame) -> DataFrame:
    """id, turn, code, category of conversations given as turns (id, turn, role, content): what critique() says of records, under turn_issues()'s rules.

    The distinct tool names that a conversation calls are one array.
    """
    rows = _reviewed_turns(turns)
    local = rows.select("id", "turn", F.inline("codes"))

    known = rows.where("call").select(F.struct("id", F.col("call_key").alias("key")).alias("link")).distinct()
    results = rows.where("result").select("id", "turn", F.struct("id", F.col("result_key").alias("key")).alias("link"))
    lost = results.join(known, "link", "left_anti").select("id", "turn", F.lit("TCID_MISMATCH").alias("code"), F.lit("TOOL_RESULT").alias("category"))

    tools = rows.where("call AND tool_name IS NOT NULL").groupBy("id").agg(F.collect_set("tool_name").alias("tools"))
    finals = to_rows(rows.where("final").select("id", "turn", "part", "answer"), tools, ["id"], "part")
    loose = finals.where(_ungrounded(F.col("answer"), F.col("tools"))).select("id", "turn", F.lit("NOT_GROUNDED").alias("code"), F.lit("FINAL_ANSWER").alias("category"))

    tests = sequence_tests(F.col("first"), F.col("last"), F.col("calls"), F.col("results"), F.col("repeats") > 0)
    whole = _sequence_facts(rows).where("n > 0").select("id", F.lit(None).cast("long").alias("turn"), F.inline(_found(tests)))
    turn = F.col("turn").cast("long").alias("turn")
    return whole.unionByName(local.withColumn("turn", turn)).unionByName(lost.withColumn("turn", turn)).unionByName(loose.withColumn("turn", turn))
