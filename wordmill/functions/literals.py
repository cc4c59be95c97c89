"""Model-sized literals (vocabularies, merge lists) built from one SQL text.

``F.lit`` on a long Python list makes one JVM call per element; parsing one
SQL expression builds the same constant in a single call.  Callers only pass
tables bounded by a model parameter (vocab_size, max_size), never data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_string(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _body(values, kind: str) -> str:
    if kind == "string":
        return ", ".join(sql_string(v) for v in values)
    return ", ".join(str(int(v)) for v in values)


def array_lit(values, kind: str = "string") -> Column:
    values = list(values)
    if not values:
        return F.array().cast(f"array<{kind}>")
    return F.expr(f"array({_body(values, kind)})")


def map_lit(keys, values, key_kind: str = "string", value_kind: str = "int") -> Column:
    return F.map_from_arrays(array_lit(keys, key_kind), array_lit(values, value_kind))


def pair_array_lit(pairs, a: str = "p", b: str = "r") -> Column:
    """``array<struct<a: string, b: string>>`` from (a, b) string pairs."""
    pairs = list(pairs)
    if not pairs:
        return F.array().cast(f"array<struct<{a}:string,{b}:string>>")
    body = ", ".join(f"named_struct('{a}', {sql_string(x)}, '{b}', {sql_string(y)})" for x, y in pairs)
    return F.expr(f"array({body})")
