"""Validation of repeated ids, sinks, reports, the command line, fallbacks and the stream."""

from __future__ import annotations

import csv
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loomline.operators import render, report, split, validate
from loomline.operators.sampler import enough_prefix
from loomline.plans import cases, cli, generate
from loomline.sources import dimensions, jsonl
from loomline.streaming import validator


def json_lines(folder):
    return [json.loads(line) for f in sorted(folder.glob("*.json")) for line in f.read_text().splitlines()]


def test_every_issue_and_code_is_in_the_cases(spark):
    table = cases.trajectories(spark)
    issues = {x for r in validate.structural_issues(table).collect() for x in r["issues"]}
    assert len(issues) == 12 + 1 + 2  # the checks, a second unknown tool, and two for JSON that is no object
    codes = {r["code"] for r in validate.critique(table).collect()}
    assert len(codes) == 22


def test_rows_are_checked_by_themselves(spark):
    """Ids repeat over datasets: a broken row says nothing of its namesakes, nor do another dataset's calls."""
    good, bad = cases.CASES["good"], cases.CASES["result of another call"]
    other = cases.conversation(call=cases.CALL | {"id": "call_2"}, result=cases.RESULT | {"tool_call_id": "call_2"})
    broken = cases.CASES["call is no JSON"]
    rows = [("a", 3, good), ("b", 3, broken), ("c", 3, bad), ("d", 3, other)]
    table = spark.createDataFrame([(d, i, [(r, c, None, None) for r, c in m]) for d, i, m in rows], f"dataset string, id long, messages {render.MESSAGE.simpleString()}")
    assert {r["dataset"]: len(r["issues"]) for r in validate.structural_issues(table).collect()} == {"a": 0, "b": 1, "c": 0, "d": 0}
    assert {r["dataset"] for r in validate.critique(table).where("code = 'TCID_MISMATCH'").collect()} == {"b", "c"}
    assert sorted(r["dataset"] for r in validate.valid_only(table).collect()) == ["a", "c", "d"]
    nothing = spark.createDataFrame([(None,), ([],)], f"messages {render.MESSAGE.simpleString()}")
    assert [r["issues"] for r in validate.structural_issues(nothing).collect()] == [["too few messages"]] * 2
    assert validate.critique(nothing).count() == 0 and validate.structural_issues(nothing.limit(0)).count() == 0


def test_split_leaves_other_columns_alone(spark):
    table = spark.range(50).select("id", *[F.lit(1).alias(c) for c in ("_n", "_b", "_h", "_start", "_in", "n", "b", "h", "start", "in", "row", "key")])
    out = split.split_70_15_15(table, "id", 3)
    assert out.columns == [*table.columns, "pos", "split"] and out.count() == 50 and out.where("_n <> 1 OR row <> 1 OR start <> 1").isEmpty()


def test_locale_fallbacks(spark, monkeypatch):
    monkeypatch.setattr(dimensions, "CONFIGS", [("fit", 1, 5, ["en"], ["casual"], ["formal"]), ("language", 2, 5, ["ja"], ["technical"], ["informal"]), ("all", 3, 5, ["xx"], ["casual"], ["formal"])])
    got = {r["dataset"]: [(x["language"], x["tone"]) for x in r["locales"]] for r in generate.config_locales(spark).collect()}
    assert got["fit"] == [("en", "casual")] and got["language"] == [("ja", "professional"), ("ja", "casual")] and len(got["all"]) == 38


def test_prefix_is_enough(spark):
    marked = spark.range(100).select(F.lit("d").alias("dataset"), F.lit("t").alias("tool_name"), "id", (F.col("id") % 10 == 9).alias("fresh"), F.lit(3).alias("n"))
    assert [enough_prefix(marked, 100, p) for p in (4, 30, 64)] == [64, 30, 64]
    assert enough_prefix(marked.withColumn("n", F.lit(50)), 100, 4) >= 100


def test_prompt_and_schemas(spark):
    schemas = [json.loads(x) for x in spark.range(1).select(F.explode(jsonl.wire_tools(spark)).alias("s")).select(F.to_json("s").alias("s")).toPandas()["s"]]
    assert [s["function"]["name"] for s in schemas] == dimensions.TOOL_NAMES
    grep = schemas[5]["function"]
    assert list(grep["parameters"]["properties"]) == ["pattern", "path", "file_types", "case_sensitive"] and grep["parameters"]["required"] == ["pattern"]
    assert "default" not in grep["parameters"]["properties"]["path"] and grep["description"] == dimensions.DESCRIPTIONS["Grep"]
    defaults = {(r["tool_name"], a["name"]): json.loads(a["default"]) for r in dimensions.tools(spark).collect() for a in r["arguments"] if a["default"]}
    assert defaults == dimensions.DEFAULTS
    row = spark.createDataFrame([("en", "casual", "formal")], "language string, tone string, formality string")
    prompt = row.select(render.system_prompt(7).alias("p")).first()["p"]
    assert "7 tools" in prompt and all(f"{n}: {d}" in prompt for n, d in dimensions.DESCRIPTIONS.items())


def test_closing_sentence_by_difficulty(spark):
    drawn = spark.createDataFrame([("d", 1, i, "Bash", d, "xx", "t", "f", True, "q", "{}") for i, d in enumerate(("easy", "hard", "expert"))], "dataset string, seed long, id long, tool_name string, difficulty string, language string, tone string, formality string, success boolean, query string, arguments string")
    ends = {r["metadata"]["difficulty"]: json.loads(r["messages"][4]["content"])["content"] for r in render.trajectories(spark, drawn, by_difficulty=True).collect()}
    assert ends["hard"].endswith(dimensions.SUCCESS_TEXTS["hard"]["en"][0]) and ends["expert"].endswith(tuple(dimensions.SUCCESS_TEXTS["easy"]["en"]))
    stamp = datetime.fromisoformat(render.trajectories(spark, drawn).first()["metadata"]["generated_at"])
    assert stamp.utcoffset().total_seconds() == 0


def test_library_intents_are_its_own(spark):
    made = generate.library_batch(spark, 800)
    per = {r["tool_name"]: r["n"] for r in dimensions.intents(spark, library=True).groupBy("tool_name").agg(F.count("*").alias("n")).collect()}
    assert per == {"Bash": 32, "File_Read": 15, "File_Write": 8, "Web_Search": 10, "Web_Fetch": 8}
    texts = {r["q"] for r in made.select(F.get("messages", F.lit(1))["content"].alias("q")).collect()}
    assert texts <= {q for _, _, q, _ in dimensions.LIBRARY_INTENTS} | {f"use {t}" for t in dimensions.TOOL_NAMES} and "use Grep" in texts


def test_review_sinks(spark, tmp_path):
    table = cases.trajectories(spark)
    jsonl.write_bad_rows(validate.structural_issues(table), str(tmp_path / "bad"))
    rows = [r for f in (tmp_path / "bad").glob("*.csv") for r in csv.reader(f.open()) if r != ["id", "issues"]]
    assert len(rows) == validate.structural_issues(table).where("size(issues) > 0").count() and ["three messages", "too few messages"] in rows
    jsonl.write_review_comments(validate.critique(table), str(tmp_path / "review"))
    comments = json_lines(tmp_path / "review")
    assert len(comments) == validate.critique(table).count() and {"id": "no user", "code": "BAD_FIRST_ROLE", "category": "SEQUENCE", "comment": "SEQUENCE: bad first role"} in comments


def test_training_form(spark):
    rows = jsonl.training_form(jsonl.records(generate.bulk(spark, 20))).collect()
    assert len(rows) == 20 and all(set(m.asDict()) == {"role", "content"} for r in rows for m in r["messages"]) and len(json.loads(rows[0]["tools"])) == 10


def test_command_line(spark, tmp_path):
    options = cli.arguments(["--count", "60", "--output-dir", str(tmp_path / "out"), "--seed", "5"])
    lines = cli.run(spark, options)
    assert {s: len(json_lines(tmp_path / "out" / f"split={s}")) for s in ("train", "eval", "test")} == {"train": 42, "eval": 9, "test": 9}
    assert sum(x.startswith("language ") for x in lines) <= 8 and lines[0].startswith("tool_name ") and "█" in lines[0]
    assert cli.arguments([]).count == 100_000 and cli.arguments([]).seed == 2026 and cli.arguments([]).error_rate == 0.15
    one = json_lines(tmp_path / "out" / "split=train")[0]
    assert list(one) == ["messages", "localization", "tools", "metadata"]


def test_markdown_report(spark, tmp_path):
    rows = spark.createDataFrame([("d", i, "en" if i % 3 else "fr", t, "hard" if i % 2 else "easy") for i, t in enumerate("abcdefab")], "dataset string, id long, language string, tool_name string, difficulty string")
    text = report.markdown(report.distribution(rows, ["language", "tool_name", "difficulty"]), paths={"d": "x/d"})
    report.write_text(spark, text, str(tmp_path / "REPORT.md"))
    read = "".join(f.read_text() for f in (tmp_path / "REPORT.md").glob("*.txt"))
    assert read.strip() == text.strip() and "- Total: 8\n- File: `x/d`" in text
    lines = text.splitlines()
    tools = lines[lines.index("**Top Tools:**") + 1 : lines.index("**Difficulty:**") - 1]
    assert [x.split(":")[0].strip(" -") for x in tools] == ["a", "b", "c", "d", "e"] and "  - a: 2 (25.0%)" in tools
    assert lines[lines.index("**Difficulty:**") + 1 :][:2] == ["  - easy: 4 (50.0%)", "  - hard: 4 (50.0%)"]


def test_stream_of_invalid_payloads(spark, tmp_path):
    table = cases.trajectories(spark).select("messages", F.lit(None).cast(jsonl.LOCALE).alias("localization"), F.lit(None).cast(jsonl.METADATA).alias("metadata"))
    jsonl.write(table, str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        validator.run_available(validator.invalid_payloads(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"))
    got = sorted(r["content"] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    def is_object(text):
        try:
            return isinstance(json.loads(text), dict)
        except ValueError:
            return False

    assert got == sorted(c for _, _, role, c in cases.rows() if role in ("assistant", "tool") and not is_object(c))


@pytest.mark.parametrize("missing", ["loomline.llm", "corpus_pipeline"])
def test_entry_without_corpus_operators(missing):
    import subprocess
    import sys

    code = f"import sys; sys.modules[{missing!r}] = None\nimport __spark_entry__ as e\nn = e.queries()\nassert 'report_grouping_sets' in n and 'pipeline' not in n and set(e.oracle_sql()) <= set(n)"
    assert subprocess.run([sys.executable, "-c", code], cwd=cli.__file__.rsplit("/loomline/", 1)[0], capture_output=True).returncode == 0
