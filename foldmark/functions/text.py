"""Text checks as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_word(text: Column, word: str) -> Column:
    return text.rlike(rf"(?i)\b{word}\b")


def transcript(role: str, text: str, turn: str) -> Column:
    """Lines ``ROLE: text`` of a group in order of turns."""
    turns = F.sort_array(F.collect_list(F.struct(F.col(turn), F.col(role).alias("r"), F.col(text).alias("x"))))
    return F.array_join(F.transform(turns, lambda t: F.concat(F.upper(F.coalesce(t["r"], F.lit(""))), F.lit(": "), F.coalesce(t["x"], F.lit("")))), "\n")


def word_windows(text: Column, n: int) -> Column:
    """Distinct windows of ``n`` words of letters, in lower case."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")
    # the words are bound to a name, or each window would split the text again
    windows = F.transform(F.array(words), lambda w: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.flatten(windows))


def numbers_in(json: Column) -> Column:
    """Every number of a JSON text that is a value, in order; those in strings and words do not count."""
    bare = F.regexp_replace(json, r'"(?:[^"\\]|\\.)*"', '""')
    return F.transform(F.regexp_extract_all(bare, F.lit(r"(?<![\w.])(-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)(?![\w.])"), F.lit(1)), lambda x: x.cast("double"))


def last_json(text: Column, schema: str) -> Column:
    """The last block in braces of a reply, read with ``schema``; null where there is none that fits."""
    block = F.regexp_extract(text, r"(?s)(\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\})(?!.*\})", 1)
    return F.when(block != "", F.from_json(block, schema))
