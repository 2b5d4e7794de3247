"""Review, repair and review again until nothing changes.

Each round reviews the records that the round before has changed, rewrites those that have a code with a rule, and sets all others aside with the
codes that are left. A round's records are a table; nothing of them comes to the driver but whether there are any.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.payload import parsed
from loomline.functions.tables import written
from loomline.operators.render import MESSAGE
from loomline.operators.validate import with_codes


class Place:
    """Where a message stands: the record's name, its turn, and the id and tool of the nearest call before it."""

    def __init__(self, name: str, turn: int, call_id: object, tool: object):
        self.new_id = "call_" + hashlib.md5(f"{name}|{turn}".encode()).hexdigest()[:12]
        self.call_id, self.tool = call_id, tool if isinstance(tool, str) else "The tool"


def _arguments(value: dict) -> dict:
    ok, inner = parsed(value.get("arguments")) if isinstance(value.get("arguments"), str) else (False, None)
    return inner if ok and isinstance(inner, dict) else {}


def _failed(output: object) -> object:
    ok, inner = parsed(output) if isinstance(output, str) else (True, output)
    return json.dumps(inner | {"exit_code": 1}) if ok and isinstance(inner, dict) else output


def _plain(text: object) -> object:
    return re.sub(r"\{([A-Za-z_]+)\}", r"\1", text) if isinstance(text, str) else text


#: What is done about a code, in this order; a message gets one rule a round, as a repair may bring up or settle others. Codes without a rule stay.
RULES: dict[str, Callable[[dict, Place], dict]] = {
    "TC_MISSING_ID": lambda v, at: v | {"id": at.new_id},
    "EMPTY_ID": lambda v, at: v | {"id": at.new_id},
    "UNSUBSTITUTED_ID": lambda v, at: v | {"id": at.new_id},
    "TC_BAD_ARGS": lambda v, at: v | {"arguments": _arguments(v)},
    "TR_MISSING_TCID": lambda v, at: v | {"tool_call_id": at.call_id},
    "UNSUBSTITUTED_TCID": lambda v, at: v | {"tool_call_id": at.call_id},
    "TCID_MISMATCH": lambda v, at: v if at.call_id is None else v | {"tool_call_id": at.call_id},
    "OUTPUT_NOT_JSON": lambda v, at: v | {"output": json.dumps({"text": v.get("output")})},
    "OUTPUT_PLACEHOLDER": lambda v, at: v | {"output": _plain(v.get("output"))},
    "EXIT_CODE_CONFLICT": lambda v, at: v | {"output": _failed(v.get("output"))},
    "FA_MISSING_CONTENT": lambda v, at: v | {"content": f"{at.tool} gave no answer."},
    "ANSWER_PLACEHOLDER": lambda v, at: v | {"content": _plain(v.get("content"))},
    "VAGUE_ANSWER": lambda v, at: v | {"content": f"{at.tool}: {v.get('content')}"},
    "NOT_GROUNDED": lambda v, at: v | {"content": f"{at.tool}: {v.get('content')}"},
}


def repaired(name: str, contents: list[str | None], codes: list[tuple[int | None, str]]) -> list[str | None]:
    """The contents of one record's messages after one rule for each message that has a code with one."""
    found: dict[int, set[str]] = {}
    for turn, code in codes:
        if turn is not None and code in RULES:
            found.setdefault(turn, set()).add(code)
    out, call_id, tool = [], None, None
    for turn, text in enumerate(contents):
        ok, value = parsed(text)
        value = value if ok and isinstance(value, dict) else None
        if value is not None and turn in found:
            rule = next(r for c, r in RULES.items() if c in found[turn])
            changed = rule(value, Place(name, turn, call_id, tool))
            if changed != value:
                text = json.dumps(changed)
        if value is not None and value.get("type") == "tool_call":
            call_id, tool = value.get("id"), value.get("tool_name")
        out.append(text)
    return out


@F.arrow_udf(T.ArrayType(T.StringType()))
def _repaired(names: pa.Array, contents: pa.Array, codes: pa.Array) -> pa.Array:
    rows = zip(names.to_pylist(), contents.to_pylist(), codes.to_pylist(), strict=True)
    return pa.array([repaired(str(n), c, [(x["turn"], x["code"]) for x in found]) if found else c for n, c, found in rows], pa.list_(pa.string()))


def until_clean(records: DataFrame, rounds: int = 20) -> DataFrame:
    """id, messages, rounds, codes of records (id, messages): the messages as repaired, in how many rounds, and the codes that are left (sorted, each once). Other
    columns (but rounds and codes) stay.

    Records without messages and those without a rule for any of their codes come out as they are, after 0 rounds. Rules that undo each other would go on for
    ever; after `rounds` rounds a record is set aside as it stands. Rows are reviewed by themselves, so ids may repeat. An empty table gives an empty result.
    """
    rest = [c for c in records.columns if c not in ("id", "messages")]
    kept = F.struct(*rest) if rest else F.lit(None).cast("string")
    todo, aside = records.select("id", "messages", F.lit(0).alias("rounds"), kept.alias("kept_")), []
    left = F.array_sort(F.array_distinct(F.transform("codes", lambda x: x["code"]))).alias("codes")
    contents = F.transform("messages", lambda m: m["content"])
    for last in [*[False] * rounds, True]:
        seen = written(with_codes(todo), "reviewed")
        aside.append(seen.where(F.lit(True) if last else F.size("codes") == 0).select("id", "messages", "rounds", left, "kept_"))
        if last:
            break
        fixed = seen.where(F.size("codes") > 0).withColumn("fixed", _repaired(F.col("id").cast("string"), contents, F.col("codes")))
        fixed = written(fixed, "repaired")
        same = F.col("fixed").eqNullSafe(contents)
        aside.append(fixed.where(same).select("id", "messages", "rounds", left, "kept_"))
        messages = F.zip_with("messages", "fixed", lambda m, text: F.struct(m["role"].alias("role"), text.alias("content"), m["tool_call_id"].alias("tool_call_id"), m["name"].alias("name"))).cast(MESSAGE)
        todo = fixed.where(~same).select("id", messages.alias("messages"), (F.col("rounds") + 1).alias("rounds"), "kept_")
        if todo.isEmpty():
            break
    out = aside[0]
    for more in aside[1:]:
        out = out.unionByName(more)
    return out.select("id", "messages", "rounds", "codes", *[F.col(f"kept_.{c}").alias(c) for c in rest])
