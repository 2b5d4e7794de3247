"""Rendering of draws into five-message trajectories, as column expressions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.draws import call_id, pick, uniform
from loomline.sources import dimensions

#: Line ends as str.splitlines counts them.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"

MESSAGE = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("role", "content", "tool_call_id", "name")]))


def argument(name: str, default: str | None = None) -> Column:
    value = F.get_json_object("arguments", f"$.{name}")
    return value if default is None else F.coalesce(value, F.lit(default))


def lines(text: Column) -> Column:
    """Number of lines, without an empty one at the end."""
    parts = F.split(text, LINE_END)
    return F.when(text == "", 0).otherwise(F.size(parts) - F.when(F.element_at(parts, -1) == "", 1).otherwise(0))


def bash_rule(command: Column) -> Column:
    """The name of the first simulator rule that a command meets, or `other`."""
    out = None
    for name, clauses in dimensions.BASH_RULES:
        test = None
        for words in clauses:
            clause = None
            for w in words:
                has = command.contains(w)
                clause = has if clause is None else clause & has
            test = clause if test is None else test | clause
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("other")


def _object(**fields: Column | str | int | bool) -> Column:
    return F.to_json(F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()]))


def output(tool: str) -> Column:
    """The simulated result of a successful call, as a JSON string; wide ladders stay one tool each."""
    if tool == "Bash":
        command = argument("command", "")
        rule = bash_rule(command)
        return F.when(rule == "other", _object(stdout=F.concat(F.lit("Ran: "), command, F.lit("\n")), stderr="", exit_code=0)).otherwise(_object(kind=rule, result="ok", total=F.when(rule == "find_py", 3).otherwise(1)))
    path = argument("file_path", "unknown")
    if tool == "File_Read":
        content = F.array(F.concat(F.lit("# "), path), F.lit(""), F.lit("alpha"), F.lit("beta"), F.lit("gamma"))
        preview = F.array_join(F.slice(content, F.lit(1), F.least(F.coalesce(argument("limit").try_cast("int"), F.lit(100)), F.lit(5))), "\n")
        return _object(path=path, bytes_read=F.octet_length(preview), lines_read=5, content=preview)
    if tool == "File_Write":
        content = argument("content", "")
        return _object(path=path, bytes_written=F.octet_length(content), lines_written=lines(content), append=F.coalesce(argument("append").cast("boolean"), F.lit(False)))
    if tool == "File_Edit":
        return _object(path=path, replacements=F.when(argument("old_string", "") != "", 1).otherwise(0), old_string=argument("old_string", ""), new_string=argument("new_string", ""))
    if tool == "Glob":
        return _object(pattern=argument("pattern", "*"), matches=F.array(F.lit("lib/a.py"), F.lit("lib/b.py"), F.lit("tests/test_a.py")), total=3)
    if tool == "Grep":
        p = argument("pattern", "")
        hits = F.array(F.concat(F.lit("lib/a.py:7:"), p), F.concat(F.lit("lib/b.py:9:"), p))
        return _object(matches=hits, total=2, pattern=p, path=argument("path", "."))
    if tool == "TodoWrite":
        return _object(todo=argument("todo", ""), status=argument("status", "pending"), updated=True)
    if tool == "TodoRead":
        return _object(todos=F.array(*[F.struct(F.lit(str(i)).alias("id"), F.lit(t).alias("todo"), F.lit(s).alias("status")) for i, t, s in ((1, "plan", "completed"), (2, "build", "in_progress"), (3, "check", "pending"))]))
    if tool == "Web_Search":
        q = argument("query", "")
        return _object(results=F.array(F.concat(F.lit("About "), q), F.concat(q, F.lit(": notes")), F.concat(q, F.lit(" in depth"))), total=3, query=q)
    if tool == "Web_Fetch":
        u = argument("url", "")
        return _object(url=u, status=200, content_length=2048, content_type="text/html", content=F.concat(F.lit("page at "), u))
    return _object(success=True)


def answer(tool: str) -> tuple[Column, Column]:
    """The summary of a call that went well, and of one that failed. A file tool without a path names `file` here, `unknown` in its result."""
    path = argument("file_path", "file")
    n = F.lit(f"{tool} ")
    if tool == "Bash":
        c = argument("command", "command")
        return F.concat(c, F.lit(": finished.")), F.concat(c, F.lit(": failed."))
    if tool == "File_Read":
        return F.concat(n, F.lit("read "), path, F.lit(": 10 lines, 256 bytes.")), F.concat(n, F.lit("could not read "), path, F.lit("."))
    if tool == "File_Write":
        return F.concat(n, F.lit("wrote "), F.octet_length(argument("content", "")).cast("string"), F.lit(" bytes to "), path, F.lit(".")), F.concat(n, F.lit("could not write "), path, F.lit("."))
    if tool == "File_Edit":
        return F.concat(n, F.lit("replaced "), F.when(argument("old_string", "") != "", "1").otherwise("0"), F.lit(" in "), path, F.lit(".")), F.concat(n, F.lit("could not change "), path, F.lit("."))
    if tool in ("Glob", "Grep"):
        p = argument("pattern", "*" if tool == "Glob" else "")
        return F.concat(n, F.lit(f"has {3 if tool == 'Glob' else 2} matches for '"), p, F.lit("'.")), F.concat(n, F.lit("has no match for '"), p, F.lit("'."))
    if tool == "TodoWrite":
        return F.concat(n, F.lit("set '"), argument("todo", ""), F.lit("' to "), argument("status", "pending"), F.lit(".")), F.concat(n, F.lit("could not set '"), argument("todo", ""), F.lit("'."))
    if tool == "TodoRead":
        return F.concat(n, F.lit("lists 3 items.")), F.concat(n, F.lit("could not list items."))
    if tool == "Web_Search":
        return F.concat(n, F.lit("has 3 results for '"), argument("query", ""), F.lit("'.")), F.concat(n, F.lit("could not search '"), argument("query", ""), F.lit("'."))
    return F.concat(n, F.lit("loaded "), argument("url", ""), F.lit(" (HTTP 200).")), F.concat(n, F.lit("could not load "), argument("url", ""), F.lit("."))


def by_tool(make) -> Column:
    out = None
    for name in dimensions.TOOL_NAMES:
        out = F.when(F.col("tool_name") == name, make(name)) if out is None else out.when(F.col("tool_name") == name, make(name))
    return out.otherwise(make("other") if make is output else F.concat("tool_name", F.lit(": done.")))


def system_prompt(num_tools: int = len(dimensions.TOOLS)) -> Column:
    """The prompt of a row's locale: a line for each tool with what it does and what it takes."""
    bullets = "\n".join(f"  - {name}: {dimensions.DESCRIPTIONS[name]} ({', '.join(a[0] for a in t) or 'no arguments'})" for name, _, _, _, t in dimensions.TOOLS)
    head = F.concat(F.lit(f"You are a command-line assistant with {num_tools} tools. Language: "), "language", F.lit(", tone: "), "tone", F.lit(", formality: "), "formality")
    return F.concat(head, F.lit(f". Call a tool when one fits.\nTools:\n{bullets}"))


def function_schemas(tools: DataFrame) -> DataFrame:
    """pos, tool_name, schema: the function-calling form of registry rows (see dimensions.tools), properties and required names in the arguments' order.

    Defaults and causes don't reach this form."""
    arguments = F.col("arguments")
    properties = F.map_from_entries(F.transform(arguments, lambda a: F.struct(a["name"].alias("key"), F.struct(a["type"].alias("type"), a["description"].alias("description"), F.lit(None).cast("array<string>").alias("enum")).alias("value"))))
    required = F.transform(F.filter(arguments, lambda a: a["required"]), lambda a: a["name"])
    parameters = F.struct(F.lit("object").alias("type"), properties.alias("properties"), required.alias("required"))
    schema = F.struct(F.lit("function").alias("type"), F.struct(F.col("tool_name").alias("name"), "description", parameters.alias("parameters")).alias("function"))
    return tools.select("pos", "tool_name", schema.alias("schema"))


def message_texts(rows: DataFrame, difficulty: Column, language: Column, out_success: str, out_error: str) -> DataFrame:
    """rows with the arrays of closing sentences that fit: a language without sentences gets the English ones, a difficulty without any those for easy."""
    spark = rows.sparkSession
    texts = dimensions.messages(spark).groupBy("kind", "difficulty", "language").agg(F.sort_array(F.collect_list(F.struct("idx", "text")))["text"].alias("texts"))
    both = texts.where("kind = 'success'").withColumnRenamed("texts", out_success).drop("kind").join(texts.where("kind = 'error'").withColumnRenamed("texts", out_error).drop("kind"), ["difficulty", "language"])
    both = both.withColumnsRenamed({"difficulty": "text_difficulty", "language": "text_language"})
    known_difficulty = F.when(difficulty.isin(*dimensions.SUCCESS_TEXTS), difficulty).otherwise("easy")
    known_language = F.when(language.isin(*dimensions.ERROR_TEXTS), language).otherwise("en")
    return rows.join(F.broadcast(both), (known_difficulty == F.col("text_difficulty")) & (known_language == F.col("text_language")), "left").drop("text_difficulty", "text_language")


def utc_now() -> str:
    """The time now, as records carry it; one value for all rows of a run."""
    return datetime.now(timezone.utc).isoformat(timespec="microseconds")


def trajectories(spark: SparkSession, drawn: DataFrame, generated_at: str | None = None, by_difficulty: bool = False) -> DataFrame:
    """dataset, id, messages, localization, metadata of drawn rows (id, seed, dataset, tool_name, difficulty, language, tone, formality, success, query, arguments).

    generated_at: now unless given. The closing sentence is the one for `medium`, or with by_difficulty for the row's own.
    """
    generated_at = generated_at or utc_now()
    about = F.broadcast(dimensions.tools(spark).select("tool_name", "category", "cause"))
    met = message_texts(drawn.join(about, "tool_name", "left"), F.col("difficulty") if by_difficulty else F.lit("medium"), F.col("language"), "done", "failed")
    u = uniform("message", F.col("seed"), F.col("id"))
    variants = F.when(F.col("success"), F.col("done")).otherwise(F.transform("failed", lambda t: F.concat(t, F.lit("failed"))))
    met = met.withColumn("call_id", call_id(F.col("seed"), F.col("id"))).withColumn("closing", F.get(variants, pick(u, F.size(variants))))
    result = F.when(F.col("success"), by_tool(output)).otherwise(_object(error=F.coalesce("cause", F.lit("unknown error")), exit_code=1))
    summary = F.when(F.col("success"), by_tool(lambda t: answer(t)[0])).otherwise(by_tool(lambda t: answer(t)[1]))
    call = F.concat(F.lit('{"type":"tool_call","id":"'), "call_id", F.lit('","tool_name":"'), "tool_name", F.lit('","arguments":'), "arguments", F.lit("}"))
    none = F.lit(None).cast("string")

    def message(role: str, content: Column, call: Column = none, name: Column = none) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"), call.alias("tool_call_id"), name.alias("name"))

    messages = F.array(
        message("system", system_prompt()),
        message("user", F.col("query")),
        message("assistant", call),
        message("tool", _object(type="tool_result", tool_call_id=F.col("call_id"), output=result), F.col("call_id"), F.col("tool_name")),
        message("assistant", _object(type="final_answer", content=F.concat_ws(" ", summary, "closing"))),
    )
    place = F.struct("language", "tone", "formality", F.lit(True).alias("humanize"), F.lit("medium").alias("humanize_level")).alias("localization")
    metadata = F.struct("difficulty", F.col("category").alias("tool_category"), "tool_name", F.array("tool_name").alias("tools_used"), F.lit(1).alias("num_tools"), "success", F.lit(generated_at).alias("generated_at"), F.lit("1.0").alias("generator_version")).alias("metadata")
    return met.select("dataset", "id", messages.cast(MESSAGE).alias("messages"), place, metadata)
