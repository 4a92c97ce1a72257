"""JSON in one form, and the last block of it in a text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _sorted(value: Column, kind: T.DataType) -> Column:
    """``value`` with the names of its structs and the keys of its maps in order, at every depth."""
    if isinstance(kind, T.StructType):
        fields = [_sorted(value[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _sorted(x, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.map_entries(F.transform_values(value, lambda k, v: _sorted(v, kind.valueType)))
        order = lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
        return F.map_from_entries(F.array_sort(entries, order))
    return value


def canonical(value: Column, kind: T.StructType) -> Column:
    """A struct as compact JSON: names and keys sorted at every depth, nulls kept. Numbers are written as Spark does."""
    return F.to_json(_sorted(value, kind), {"ignoreNullFields": "false"})


def _last_block(text: str | None) -> str | None:
    """The block in braces that closes last, by depth; braces within strings do not count, and an unclosed one before
    it does not hide it."""
    starts: list[int] = []
    found, quoted, escaped = None, False, False
    for k, c in enumerate(text or ""):
        if quoted:
            quoted, escaped = (escaped or c != '"'), not escaped and c == "\\"
        elif c == '"' and starts:
            quoted = True
        elif c == "{":
            starts.append(k)
        elif c == "}" and starts:
            found = (starts.pop(), k + 1)
    return text[found[0] : found[1]] if found else None


def last_block(text: Column) -> Column:
    """The last balanced block in braces of a text, whatever its depth; null without one."""

    @F.pandas_udf("string")
    def find(texts: pd.Series) -> pd.Series:
        return texts.map(_last_block)

    return find(text)
