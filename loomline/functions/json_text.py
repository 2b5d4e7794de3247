"""JSON text as json.dumps writes it, byte for byte, as column expressions: with its default escapes of all that isn't ASCII, and without them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SHORT = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
_CONTROL = [c for c in map(chr, range(32)) if c not in _SHORT]


def dumps_text(text: Column, ascii: bool = True) -> Column:
    """A string in quotes; with ascii, the UTF-16 units of all but printable ASCII as \\uxxxx (two of them for those beyond the first plane). Null gives null."""
    out = text
    for c, short in _SHORT.items():
        out = F.replace(out, F.lit(c), F.lit(short))
    rare = out
    for c in _CONTROL:
        rare = F.replace(rare, F.lit(c), F.lit(f"\\u{ord(c):04x}"))
    out = F.when(out.rlike("[\\x00-\\x1f]"), rare).otherwise(out)
    if ascii:
        units = lambda run: F.regexp_replace(F.lower(F.hex(F.encode(run, "UTF-16BE"))), "(.{4})", "\\\\u$1")
        runs = F.transform(F.regexp_extract_all(out, F.lit("[\\x00-\\x7e]+|[^\\x00-\\x7e]+"), F.lit(0)), lambda run: F.when(run.rlike("^[\\x00-\\x7e]"), run).otherwise(units(run)))
        out = F.when(out.rlike("[^\\x00-\\x7e]"), F.array_join(runs, "")).otherwise(out)
    return F.concat(F.lit('"'), out, F.lit('"'))


def dumps(value: Column, kind: T.DataType, ascii: bool = True) -> Column:
    """A value of strings, whole numbers, booleans, and structs, arrays and string-keyed maps of these, with json.dumps's separators; null gives `null`.

    Fractions are left out on purpose: the JVM and Python write them differently.
    """
    if isinstance(kind, T.StringType):
        made = dumps_text(value, ascii)
    elif isinstance(kind, (T.IntegralType, T.BooleanType)):
        made = value.cast("string")
    elif isinstance(kind, T.StructType):
        fields = [F.concat(dumps_text(F.lit(f.name), ascii), F.lit(": "), dumps(value[f.name], f.dataType, ascii)) for f in kind]
        made = F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
        made = F.when(value.isNotNull(), made)
    elif isinstance(kind, T.ArrayType):
        made = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: dumps(x, kind.elementType, ascii)), ", "), F.lit("]"))
    elif isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        entry = lambda e: F.concat(dumps_text(e["key"], ascii), F.lit(": "), dumps(e["value"], kind.valueType, ascii))
        made = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(value), entry), ", "), F.lit("}"))
    else:
        raise TypeError(f"no JSON text for {kind.simpleString()}")
    return F.coalesce(made, F.lit("null"))
