"""Which names of a catalogue a written name could mean: ids, equal names, telling words, edit similarity.

The similarity of two texts is twice the length of their matching blocks over their common length: the longest
common block first (of equal ones the first in the query, then in the name), then what lies left and right of it.
The best names of a query are found without comparing it with all of the catalogue:

* Telling words are those that at most a quarter of the catalogue has. Where a share of ``least`` of the query's words
  must be shared, one of its rarest words must be, so only lists of these are read.
* Matching blocks of M signs in B pieces have M - B pairs of neighbours in common, and there are no more pieces than
  unmatched signs and one. So texts of a similarity of r share at least ``(1.5 r - 1) * (la + lb) - 1`` pairs, and
  ``r * (la + lb) / 2`` single signs. By either bound one of the rarest pairs (signs) of both texts is common: an
  index of these gives all candidates, the bound itself and the exact similarity are computed for them alone.
* A first search asks for ``STRONG``. Where a query then has k answers, by words or similarity, only what is at least as
  good as the last of them is looked for; only queries with fewer are searched down to ``least``.
"""

from __future__ import annotations

from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldmark.sources.scratch import cut, small

COMMON_SHARE, STRONG, SALTS = 4, 0.8, 32


def words_of(text: Column) -> Column:
    """Distinct lower-case runs of letters a to z and digits."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1)))


def matching_share(a: Column, b: Column) -> Column:
    """Similarity of two texts by matching blocks; two empty texts are equal."""

    @F.pandas_udf("double")
    def share(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, p, q, autojunk=False).ratio() for p, q in zip(x, y, strict=True)], dtype=float)

    return share(a, b)


def numbered_grams(text: Column, n: int) -> Column:
    """The runs of ``n`` signs, equal ones numbered, so that what two arrays have in common counts how often both have it."""

    @F.pandas_udf("array<string>")
    def grams(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            seen: Counter[str] = Counter()
            own = []
            for k in range(len(t) - n + 1):
                g = t[k : k + n]
                seen[g] += 1
                own.append(f"{g}{seen[g]}")
            out.append(own)
        return pd.Series(out, dtype=object)

    return grams(text)


def _need(n: int, r: Column, la: Column, lb: Column) -> Column:
    """Grams of ``n`` signs that texts of these lengths with a similarity of ``r`` surely share."""
    total = (la + lb).cast("double")
    bound = (r * 1.5 - 1) * total - 1 if n == 2 else r / 2 * total
    return F.ceil(bound - 1e-9)


def _least_partner(r: Column, length: Column) -> Column:
    return F.ceil(length * (r / (F.lit(2.0) - r)) - 1e-9)


def _rarest(texts: DataFrame, often: DataFrame, n: int) -> DataFrame:
    """``text, gram``: the rarest grams of each text (text, length, grams, r), so many that a text with a similarity of ``r``
    must have one of its own rarest among them."""
    need = F.greatest(F.lit(1), _need(n, F.col("r"), F.col("length"), _least_partner(F.col("r"), F.col("length"))))
    rows = texts.select("text", (F.size("grams") - need + 1).alias("take"), F.explode("grams").alias("gram")).join(often, "gram", "left")
    place = F.row_number().over(Window.partitionBy("text").orderBy(F.coalesce("held", F.lit(0)), "gram"))
    return rows.withColumn("place", place).where("place <= take").select("text", "gram")


def similar(queries: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """``query, text, similarity`` of all pairs of at least the query's ``r``: ``queries`` (text, r) and ``texts`` (text), distinct.

    With pairs (``n`` = 2) only queries long enough for the bound are answered, see :func:`answerable`. Queries are few.
    """
    sized = lambda df: df.withColumns({"length": F.length("text"), "grams": numbered_grams(F.col("text"), n)} | ({"pairs": numbered_grams(F.col("text"), 2)} if n == 1 else {}))
    asked, held = cut(sized(queries.select("text", F.col("r").cast("double").alias("r")))), cut(sized(texts.select("text")))
    lowest = asked.agg(F.min("r")).first()[0]
    if lowest is None:
        return asked.select(F.col("text").alias("query"), "text", F.col("r").alias("similarity"))
    often = cut(held.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("held")))
    ask, have = _rarest(asked, small(often), n), _rarest(held.withColumn("r", F.lit(lowest)), small(often), n)
    near = have.join(small(cut(ask.withColumnRenamed("text", "query"))), "gram").select("query", "text").distinct()
    own = asked.select(F.col("text").alias("query"), "r", F.col("length").alias("asked"), F.col("grams").alias("own"), *([F.col("pairs").alias("own_pairs")] if n == 1 else []))
    near = near.join(held, "text").join(small(own), "query")
    r, la, lb = F.col("r"), F.col("asked"), F.col("length")
    enough = (2.0 * F.least(la, lb) >= r * (la + lb) - 1e-9) & (F.size(F.array_intersect("grams", "own")) >= _need(n, r, la, lb))
    if n == 1:
        enough = enough & (F.size(F.array_intersect("pairs", "own_pairs")) >= _need(2, r, la, lb))
    # the blocks of a pair are computed once: a filter on the result would have Spark compute them again
    return cut(near.where(enough).select("query", "text", "r", matching_share(F.col("query"), F.col("text")).alias("similarity"))).where(F.col("similarity") >= F.col("r")).drop("r")


def answerable(text: Column, r: float) -> Column:
    """Whether texts similar to this one must share a pair of signs with it."""
    return _need(2, F.lit(r), F.length(text), _least_partner(F.lit(r), F.length(text))) >= 1


def _first_ids(rows: DataFrame, by: str, k: int) -> DataFrame:
    """The ``k`` least ids of each text, first in salted parts: one name may be that of a third of the catalogue."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    first = salted.withColumn("place", F.row_number().over(Window.partitionBy(by, "salt").orderBy("id"))).where(F.col("place") <= k)
    return first.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy("id"))).where(F.col("place") <= k).drop("salt", "place")


def telling_words(catalogue: DataFrame) -> DataFrame:
    """``word``: those that at most one in ``COMMON_SHARE`` of the catalogue (id, name) has in its name or id."""
    own = catalogue.select(F.explode(F.array_union(words_of(F.col("name")), words_of(F.col("id")))).alias("word"))
    counts = own.groupBy("word").agg(F.count("*").alias("held"))
    return counts.crossJoin(F.broadcast(catalogue.agg(F.count("*").alias("all_")))).where(F.col("held") <= F.col("all_") / COMMON_SHARE).select("word", "held")


def best_names(queries: DataFrame, catalogue: DataFrame, k: int = 5, least: float = 0.5, shorthand: dict[str, str] | None = None) -> DataFrame:
    """``query_id, id, score, place``: the ``k`` best of ``catalogue`` (id, name, perhaps alias) for each of ``queries`` (query_id, text).

    The score is the better of the similarity to name or id (lower case) and the share of the query's words that are
    telling and on the name or id; one more where the query names the alias, itself or by its ``shorthand``. Scores under
    ``least`` do not count, equal ones go by the id. A query without any word has no answer, and neither has a null.
    Queries are a stated set that is far smaller than the catalogue; equal texts are asked once.
    """
    alias_given = "alias" in catalogue.columns
    alias = F.col("alias") if alias_given else F.lit(None).cast("string")
    catalogue = cut(catalogue.where(F.col("id").isNotNull()).select(F.col("id").cast("string").alias("id"), F.coalesce("name", "id").alias("name"), alias.alias("alias")))
    asked = queries.select("query_id", F.lower(F.trim("text")).alias("query")).where(F.size(words_of(F.col("query"))) > 0)
    asked = cut(asked)
    texts = asked.select("query").distinct()
    telling = cut(telling_words(catalogue))
    # ids of equal names: of each name the k least ones can be among the best, all others have as good a one before them
    named = catalogue.select("id", F.lower("name").alias("text"))
    spelled = cut(_first_ids(named.unionByName(catalogue.select("id", F.lower("id").alias("text"))).distinct(), "text", k))

    query_words = cut(texts.select("query", F.explode(words_of(F.col("query"))).alias("word"), F.size(words_of(F.col("query"))).alias("n")).join(telling, "word"))
    shared = cut(_by_words(query_words, spelled, telling, least, k).unionByName(_by_ids(query_words, catalogue, telling)))
    found = shared.select("query", "id", F.col("share").alias("score"))
    if alias_given:
        found = found.unionByName(_by_alias(texts, catalogue, query_words, shorthand or {}))

    names = cut(spelled.select("text").distinct())
    strong = similar(texts.where(answerable(F.col("query"), STRONG)).select(F.col("query").alias("text"), F.lit(STRONG).alias("r")), names, 2)
    by_text = lambda df: df.join(spelled, "text").select("query", "id", F.col("similarity").alias("score"))
    found = cut(found.unionByName(by_text(strong)).groupBy("query", "id").agg(F.max("score").alias("score")))
    last = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    bars = found.withColumn("place", last).where(F.col("place") == k).select("query", F.col("score").alias("bar"))
    rest = texts.join(bars, "query", "left").where(~answerable(F.col("query"), STRONG) | F.coalesce(F.col("bar") < STRONG, F.lit(True)))
    # a score above one has an alias in it, which no similarity reaches
    weak = similar(rest.where("coalesce(bar, 0) <= 1").select(F.col("query").alias("text"), F.greatest(F.lit(least), F.coalesce("bar", F.lit(0.0))).alias("r")), names, 1)
    best = found.unionByName(by_text(weak)).groupBy("query", "id").agg(F.max("score").alias("score")).where(F.col("score") >= least)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    best = best.withColumn("place", place).where(F.col("place") <= k)
    return asked.join(best, "query").select("query_id", "id", "score", "place")


def _by_words(query_words: DataFrame, spelled: DataFrame, telling: DataFrame, least: float, k: int) -> DataFrame:
    """Shares of words for texts whose words alone reach ``least``, through the rarest of the query's telling words."""
    per = Window.partitionBy("query")
    need = F.ceil(F.col("n") * least - 1e-9)
    rare = query_words.withColumn("m", F.count("*").over(per)).withColumn("place", F.row_number().over(per.orderBy("held", "word")))
    rare = rare.where(F.col("place") <= F.col("m") - need + 1).select("query", "word")
    held = cut(spelled.select("text").distinct().select("text", F.explode(words_of(F.col("text"))).alias("word")).join(telling.select("word"), "word", "left_semi"))
    pairs = held.join(small(cut(rare)), "word").select("query", "text").distinct()
    hits = pairs.join(held, "text").join(small(query_words), ["query", "word"]).groupBy("query", "text").agg((F.count("*") / F.first("n")).alias("share"))
    return hits.where(F.col("share") >= least).join(spelled, "text").select("query", "id", "share")


def _by_ids(query_words: DataFrame, catalogue: DataFrame, telling: DataFrame) -> DataFrame:
    """Shares over name and id together, for what a query names by a word of its id."""
    own = catalogue.select("id", F.explode(words_of(F.col("id"))).alias("word")).join(small(query_words.select("query", "word")), "word").select("query", "id").distinct()
    every = own.join(catalogue.select("id", F.explode(F.array_union(words_of(F.col("name")), words_of(F.col("id")))).alias("word")), "id")
    return every.join(small(query_words), ["query", "word"]).groupBy("query", "id").agg((F.count("*") / F.first("n")).alias("share"))


def _by_alias(texts: DataFrame, catalogue: DataFrame, query_words: DataFrame, shorthand: dict[str, str]) -> DataFrame:
    """Scores of what the query names by alias: one more than without."""
    word = F.explode(words_of(F.col("query")))
    means = F.coalesce(*([F.element_at(F.create_map(*(F.lit(x) for pair in shorthand.items() for x in pair)), F.col("word"))] if shorthand else []), F.upper("word"))
    pairs = texts.select("query", word.alias("word")).select("query", means.alias("alias")).distinct().join(catalogue, "alias")
    every = F.array_union(words_of(F.col("name")), words_of(F.col("id")))
    hits = pairs.select("query", "id", F.explode(every).alias("word")).join(query_words, ["query", "word"]).groupBy("query", "id").agg((F.count("*") / F.first("n")).alias("share"))
    like = F.greatest(matching_share(F.col("query"), F.lower("name")), matching_share(F.col("query"), F.lower("id")))
    return pairs.join(hits, ["query", "id"], "left").select("query", "id", (F.greatest(F.coalesce("share", F.lit(0.0)), like) + 1).alias("score"))


def resolved(queries: DataFrame, catalogue: DataFrame) -> DataFrame:
    """``query_id, id``: the entry whose id is the text, else the one of the least id whose name is, whatever the case; null for neither."""
    by_id = catalogue.select(F.col("id").alias("text"), F.col("id").alias("exact")).distinct()
    by_name = catalogue.groupBy(F.lower("name").alias("lowered")).agg(F.min("id").alias("named"))
    found = queries.select("query_id", "text").join(by_id, "text", "left").join(by_name, F.lower("text") == F.col("lowered"), "left")
    return found.select("query_id", F.coalesce("exact", "named").alias("id"))
