"""What a message's content holds: one json.loads for each says both whether it is JSON and what is in it.

No parser on the JVM draws the line where json.loads does (tails, single quotes, NaN, repeated keys), so none of them may look at the content a
second time: all that the checks ask comes from this one parse, as a typed struct.
"""

from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from loomline.functions.slices import slices

#: json: `object`, `other` (JSON of another kind) or null (json.loads rejects it); everything after it is of objects only. `_key` fields tell values of
#: different types apart, the plain ones are the text, or what Python's str() makes of another value; null and missing fields are null.
PAYLOAD = pa.struct(
    {
        "json": pa.string(),
        "keys": pa.list_(pa.string()),
        "type": pa.string(),
        "id": pa.string(),
        "id_key": pa.string(),
        "tool_name": pa.string(),
        "tool_known": pa.bool_(),
        "arguments_kind": pa.string(),
        "argument_names": pa.list_(pa.string()),
        "tool_call_id": pa.string(),
        "tool_call_id_key": pa.string(),
        "output": pa.string(),
        "output_json": pa.string(),
        "exit_zero": pa.bool_(),
        "answer": pa.string(),
        "answer_falsy": pa.bool_(),
    }
)
_DDL = {pa.string(): "string", pa.bool_(): "boolean", pa.list_(pa.string()): "array<string>"}
#: The fields that the validator looks at; the critic takes all.
VALIDATED = ("json", "keys", "type", "tool_name", "tool_known", "answer_falsy")
ALL = tuple(f.name for f in PAYLOAD)
_KINDS = {dict: "object", list: "list", str: "text", bool: "boolean", int: "number", float: "number", type(None): "null"}


def parsed(text: str | None) -> tuple[bool, object]:
    """Whether json.loads takes the text, and its value. Nesting or numbers that are beyond Python's limits count as not JSON."""
    try:
        return True, json.loads(text)
    except (TypeError, ValueError, RecursionError):
        return False, None


def _utf8(text: str | None) -> str | None:
    """The text, with half surrogate pairs (which JSON can escape, but UTF-8 can't hold) as question marks."""
    return text if text is None or text.isascii() else text.encode("utf-8", "replace").decode()


def _shown(value: object) -> str | None:
    return None if value is None else _utf8(value if isinstance(value, str) else str(value))


def payload(text: str | None, tools: frozenset[str], links: bool = True) -> dict | None:
    """The fields of PAYLOAD for one content; without links only those that VALIDATED names are sure to be there."""
    ok, value = parsed(text)
    if not ok:
        return {}
    if not isinstance(value, dict):
        return {"json": "other"}
    kind, name, answer = value.get("type"), value.get("tool_name"), value.get("content")
    out = {
        "json": "object",
        "keys": [_utf8(k) for k in value],
        "type": _utf8(kind) if isinstance(kind, str) else None,
        "tool_name": _shown(name),
        "tool_known": isinstance(name, str) and name in tools,
        "answer_falsy": not answer,
    }
    if not links:
        return out
    arguments, output = value.get("arguments"), value.get("output")
    out["arguments_kind"] = _KINDS[type(arguments)] if "arguments" in value else None
    out["argument_names"] = [_utf8(k) for k in arguments] if isinstance(arguments, dict) else []
    out["answer"] = _shown(answer)
    for field in ("id", "tool_call_id"):
        out[field] = _shown(value.get(field))
        out[f"{field}_key"] = json.dumps(value.get(field), sort_keys=True)
    if output is not None:
        inner_ok, inner = parsed(output) if isinstance(output, str) else (True, output)
        out["output"] = _utf8(output) if isinstance(output, str) else json.dumps(output)
        out["output_json"] = ("object" if isinstance(inner, dict) else "other") if inner_ok else None
        code = inner.get("exit_code") if isinstance(inner, dict) else None
        out["exit_zero"] = type(code) in (int, float) and code == 0
    return out


def payload_array(texts: pa.Array, tools: frozenset[str], names: tuple[str, ...] = ALL) -> pa.Array:
    """PAYLOAD's fields of these names for each text. Only one slice's values are Python objects at a time, however long the array is."""
    links, fields = not set(names) <= set(VALIDATED), [PAYLOAD.field(n) for n in names]
    parts = [pa.array([], pa.struct(fields))]
    for part in slices(texts):
        found = [payload(t, tools, links) for t in part.to_pylist()]
        parts.append(pa.StructArray.from_arrays([pa.array([p.get(f.name) for p in found], f.type) for f in fields], fields=fields))
    return pa.concat_arrays(parts)


def _ddl(names: tuple[str, ...]) -> str:
    return f"struct<{', '.join(f'{n}: {_DDL[PAYLOAD.field(n).type]}' for n in names)}>"


def payload_of(tools: list[str], names: tuple[str, ...] = ALL):
    """A function of a content column: its PAYLOAD's fields of these names; null contents have one whose json is null."""
    known = frozenset(tools)

    @F.arrow_udf(_ddl(names))
    def one(contents: pa.Array) -> pa.Array:
        return payload_array(contents, known, names)

    return one


def payloads_of(tools: list[str], names: tuple[str, ...] = ALL):
    """A function of an array of contents: the PAYLOAD's fields of these names for each; a null array stays null."""
    known = frozenset(tools)

    @F.arrow_udf(f"array<{_ddl(names)}>")
    def each(contents: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(contents), 0)
        ends = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes).cast(pa.int32())])
        return pa.ListArray.from_arrays(ends, payload_array(contents.flatten(), known, names), mask=contents.is_null())

    return each
