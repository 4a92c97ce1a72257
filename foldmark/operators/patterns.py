"""Which of many names a text names, as whole words: runs of a text's words and gaps, joined with the names' forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of all forms that may be broadcast; more forms are joined by shuffle.
BLOCK_LETTERS = 4_000_000

_WORD = r"[\p{L}\p{N}_]"
_TOKENS = rf"{_WORD}+|[^\p{{L}}\p{{N}}_]+"


def spellings(names: DataFrame) -> DataFrame:
    """``name, form`` of ``names`` (name, kind): the lower-case name; a ``bias`` with blanks for underscores, too; of
    any other kind only names with an underscore, as plain words may be said."""
    raw = F.lower("name")
    forms = F.when(F.col("kind") == "bias", F.array_distinct(F.array(raw, F.replace(raw, F.lit("_"), F.lit(" "))))).when(F.contains(raw, F.lit("_")), F.array(raw)).otherwise(F.array().cast("array<string>"))
    return names.where(F.col("name").isNotNull() & (F.col("name") != "")).select("name", F.explode(forms).alias("form")).distinct()


def _tokens(text: Column) -> Column:
    """Runs of word signs and of other ones, in turn: all of the text."""
    return F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0))


def _runs(tokens: Column, words_first: Column, size: int, word: bool) -> Column:
    """The runs of ``size`` tokens that begin with a word, or with a gap, where both edges lie between a word and something
    else: a gap at an end of the text has no such edge."""
    first = F.when(words_first, F.lit(0 if word else 1)).otherwise(F.lit(1 if word else 2))
    last = F.size(tokens) - size - (0 if word == (size % 2 == 1) else 1)
    at = F.when(last >= first, F.sequence(first, last, F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.array_join(F.slice(tokens, i + 1, size), ""))


def named(texts: DataFrame, by: list[str], text: str, forms: DataFrame, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """``by, name``, distinct: the names of ``forms`` (name, form) that a ``text`` names as whole words, in lower case on both sides.

    A form whose edges are edges of words is a run of whole tokens of the text, so texts and forms meet by equality. Only
    runs of as many tokens as some form has are made; no task holds all forms unless they are few.
    """
    shape = forms.select(F.size(_tokens(F.col("form"))).alias("size"), F.rlike("form", F.lit(f"^{_WORD}")).alias("word"), F.length("form").alias("letters"))
    shapes = shape.groupBy("size", "word").agg(F.sum("letters").alias("letters")).collect()  # a row for each count of words in a name
    if not shapes:
        return texts.select(*by, F.lit("").alias("name")).limit(0)
    lower = texts.select(*by, F.lower(F.coalesce(text, F.lit(""))).alias("__lower"))
    cut = lower.select(*by, _tokens(F.col("__lower")).alias("__tokens"), F.rlike("__lower", F.lit(f"^{_WORD}")).alias("__word"))
    runs = F.flatten(F.array(*(_runs(F.col("__tokens"), F.col("__word"), s["size"], s["word"]) for s in shapes)))
    said = cut.select(*by, F.explode(F.array_distinct(runs)).alias("form"))
    few = sum(s["letters"] for s in shapes) <= block_letters
    return said.join(F.broadcast(forms) if few else forms, "form").select(*by, "name").distinct()


def leaks(turns: DataFrame, names: DataFrame, by: list[str], role: str, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """``by, reasons`` of the sessions whose turns (role, text) of ``role`` name one of ``names`` (name, kind): sorted, each once."""
    said = named(turns.where(F.col("role") == role).select(*by, "text"), by, "text", spellings(names), block_letters)
    reasons = F.transform(F.sort_array(F.collect_list("name")), lambda n: F.concat(F.lit("names a parameter: "), n))
    return said.groupBy(*by).agg(reasons.alias("reasons"))
