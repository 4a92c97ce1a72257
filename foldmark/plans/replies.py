"""Replies: deterministic checks, scores of judgements, quotes, templates.

The replies are the assistant's turns, in a shape by number, so that every check has replies of both outcomes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.functions import replies
from foldmark.plans.registry import query, table

SHAPES = (
    "coalesce(text, '')", "concat('- ', replace(coalesce(text, ''), '. ', concat('.', chr(10), '- ')))", "concat('# One', chr(10), coalesce(text, ''), chr(10), '## Two', chr(10), 'end')",
    "concat('| a | b |', chr(10), '|---|:---:|', chr(10), '| 1 | 2 |')", "'It moved 12bp and perhaps 3%.'", "'High confidence. Spreads may widen 5 basis points.'",
    "concat('(B) because', chr(10), chr(10), '2) so')", "''", "'A. Or C'", "'May comes, at 12 per cent; conviction is 80%.'",
)
_CASES = " ".join(f"WHEN {k} THEN {x}" for k, x in enumerate(SHAPES))
REPLIES_SQL = f"replies AS (SELECT conv_id, turn, CASE (conv_id + turn) % {len(SHAPES)} {_CASES} END AS reply FROM conversations WHERE role = 'assistant')"
KINDS = ("bullets", "prose_paragraph", "table", "headers", "units_bp", "units_percent", "units_both", "one_sentence", "two_to_three_sentences", "short_page", "no_hedges", "confidence_level", "judge")
#: What a held preference asks of a reply: param, value, kind of check.
CHECK_MAP = (("response_format", "bullets", "bullets"), ("response_format", "table", "table"), ("number_language", "bp", "units_bp"), ("number_language", "both", "units_both"), ("length", "one", "one_sentence"), ("tone", "plain", "judge"))
ANSWERS = ("format: response_format=bullets; number_language=bp; intrusion: none", "format: none; intrusion: none", "format: response_format=table; length=one; tone=plain; intrusion: none", "format: number_language=both; intrusion: none", "format: x; intrusion: none")


def replies_of(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").where("role = 'assistant'").select("conv_id", "turn", F.expr(f"CASE (conv_id + turn) % {len(SHAPES)} {_CASES} END").alias("reply"))


_S = r"trim(reply, ' ' || chr(9) || chr(10) || chr(13))"
_LINES = f"list_filter(list_transform(string_split({_S}, chr(10)), lambda x: rtrim(x)), lambda x: x <> '')"
_BLANK = "(' ', chr(9))"
_ITEM = f"""((substr(ltrim(x), 1, 1) IN ('-', '*', '•') AND substr(ltrim(x), 2, 1) IN {_BLANK}) OR (ltrim(x, ' 0123456789') <> ltrim(x) AND substr(ltrim(ltrim(x), '0123456789'), 1, 1) IN ('.', ')') AND substr(ltrim(ltrim(x), '0123456789'), 2, 1) IN {_BLANK}))"""
_ROW, _HEAD = "(length(x) - length(replace(x, '|', '')) >= 2)", f"(length(x) - length(ltrim(x, '#')) BETWEEN 1 AND 6 AND substr(ltrim(x, '#'), 1, 1) IN {_BLANK} AND trim(ltrim(x, '#')) <> '')"
# cells of the line below, without a bar at either end
_CELLS = "string_split(trim(l[i + 1])[CASE WHEN starts_with(trim(l[i + 1]), '|') THEN 2 ELSE 1 END:CASE WHEN ends_with(trim(l[i + 1]), '|') THEN -2 ELSE -1 END], '|')"
_RULE = f"""(len({_CELLS}) >= 2 AND len(list_filter(list_transform({_CELLS}, lambda c: trim(c)[CASE WHEN starts_with(trim(c), ':') THEN 2 ELSE 1 END:CASE WHEN ends_with(trim(c), ':') THEN -2 ELSE -1 END]), lambda c: length(c) < 3 OR trim(c, '-') <> '')) = 0)"""
_N = f"(CASE WHEN {_S} = '' THEN 0 ELSE 1 + len(regexp_extract_all({_S}, '[.!?]\\s+')) END)"
_W = "string_split_regex(lower({x}), '[^a-z0-9_]+')"
_BP = f"(len(list_filter({_W.format(x='reply')}, lambda w: string_split_regex(w, '[0-9_]')[-1] IN ('bp', 'bps'))) > 0 OR contains(lower(reply), 'basis point'))"
_PCT = f"(contains(reply, '%') OR list_contains({_W.format(x="replace(lower(reply), 'per cent', 'percent')")}, 'percent'))"
# a number, a percent sign, words and marks; what is held at place k, and how much right before it, or behind it and a word between
_T = r"regexp_extract_all(regexp_replace(lower(reply), '([0-9])[.]([0-9])', '\1\2', 'g'), '[0-9]+\b|\w+|[^\s\w]')"
_AFTER = "k + 1 + CASE WHEN coalesce(t[k + 1], '') = 'level' THEN 1 ELSE 0 END"
_MORE = f"({_AFTER} + CASE WHEN coalesce(t[{_AFTER}], '') IN ('of', 'at', 'is', ':') THEN 1 ELSE 0 END)"
_CONF = f"""(len(list_filter(range(1, len(t) + 1), lambda k: t[k] IN ('confidence', 'conviction') AND (k > 1 AND t[k - 1] IN ('high', 'medium', 'low') OR k > 2 AND t[k - 1] = '%' AND TRY_CAST(t[k - 2] AS DOUBLE) IS NOT NULL
  OR coalesce(t[{_MORE}], '') IN ('high', 'medium', 'low') OR TRY_CAST(coalesce(t[{_MORE}], '') AS DOUBLE) IS NOT NULL AND coalesce(t[{_MORE} + 1], '') = '%'))) > 0)"""
_HEDGE = rf"(regexp_matches(lower(reply), '\b({'|'.join(replies.HEDGES)})\b') OR regexp_matches(reply, '\bmay\b'))"


def _units(bp: str, pct: str) -> str:
    return f"CASE WHEN NOT {_BP} AND NOT {_PCT} THEN 'not_applicable' WHEN {_BP} = {bp} AND {_PCT} = {pct} THEN 'pass' ELSE 'fail' END"


_CHECKS = {
    "bullets": f"(len(l) >= 2 AND len(list_filter(l, lambda x: NOT {_ITEM})) = 0)", "prose_paragraph": rf"(NOT regexp_matches({_S}, '\n\s*\n') AND len(list_filter(l, lambda x: {_ITEM} OR {_ROW} OR {_HEAD})) = 0)",
    "table": f"(len(list_filter(range(1, len(l)), lambda i: length(l[i]) - length(replace(l[i], '|', '')) >= 2 AND {_RULE})) > 0)", "headers": f"(len(list_filter(l, lambda x: {_HEAD})) >= 2)",
    "one_sentence": f"({_N} = 1)", "two_to_three_sentences": f"({_N} BETWEEN 2 AND 3)", "short_page": r"(len(regexp_extract_all(reply, '\S+')) <= 40)", "no_hedges": f"(NOT {_HEDGE})", "confidence_level": _CONF,
}
_OUTCOME = (
    "CASE kind " + " ".join(f"WHEN '{k}' THEN CASE WHEN {x} THEN 'pass' ELSE 'fail' END" for k, x in _CHECKS.items())
    + f" WHEN 'units_bp' THEN {_units('true', 'false')} WHEN 'units_percent' THEN {_units('false', 'true')} WHEN 'units_both' THEN {_units('true', 'true')} END"
)


@query(f"WITH {REPLIES_SQL} SELECT conv_id, turn, kind, {_OUTCOME} AS outcome FROM (SELECT *, {_LINES} AS l, {_T} AS t FROM replies), (SELECT unnest({list(KINDS)}) AS kind)")
def reply_checks(spark: SparkSession, d: str) -> DataFrame:
    """Every kind of check on every reply; a kind that needs a judge has no outcome."""
    rows = replies_of(spark, d).withColumn("kind", F.explode(F.array(*map(F.lit, KINDS))))
    return rows.select("conv_id", "turn", "kind", replies.checked(F.col("kind"), F.col("reply"), 40).alias("outcome"))


_MAP_SQL = "check_map AS (SELECT * FROM (VALUES " + ", ".join(map(repr, CHECK_MAP)) + ") AS m(param, value, kind))"
_ANSWER = "CASE conv_id % 5 " + " ".join(f"WHEN {k} THEN '{a}'" for k, a in enumerate(ANSWERS)) + " END"


def held_checks(rows: DataFrame, answer: Column, check_map: DataFrame) -> DataFrame:
    """A row for each preference that an answer key holds and a deterministic check covers, with its ``kind``."""
    pairs = rows.withColumn("pair", F.explode(replies.routine_pairs(answer))).select(*rows.columns, "pair.*")
    return pairs.join(F.broadcast(check_map), ["param", "value"]).where("kind <> 'judge'")


def format_score(checked: DataFrame, keys: list[str]) -> DataFrame:
    """``correct, detail`` of each reply from its ``outcome``s: all that apply must pass; no row where none applies; an empty reply is wrong."""
    failed = F.array_join(F.array_sort(F.collect_list(F.when(F.col("outcome") == replies.FAIL, F.concat_ws("=", "param", "value")))), "; ")
    empty = F.first(replies.stripped(F.col("reply")) == "")
    out = checked.groupBy(*keys).agg(failed.alias("failed"), F.count_if(F.col("outcome") == replies.NOT_APPLICABLE).alias("na"), F.count("*").alias("n"), empty.alias("empty"))
    out = out.where("empty OR na < n")
    return out.select(*keys, (~F.col("empty") & (F.col("failed") == "")).alias("correct"), F.when(F.col("empty"), "empty reply").when(F.col("failed") != "", F.col("failed")).alias("detail"))


@query(f"""
WITH {REPLIES_SQL}, {_MAP_SQL}, a AS (SELECT *, {_ANSWER} AS answer FROM replies), b AS (SELECT *, regexp_extract(answer, '^format: (.*); intrusion: none$', 1) AS body FROM a),
p AS (SELECT conv_id, turn, reply, unnest(string_split(body, '; ')) AS item FROM b WHERE contains(body, '=')),
k AS (SELECT p.*, kind, m.param || '=' || m.value AS name FROM p JOIN check_map m ON item = m.param || '=' || m.value WHERE kind <> 'judge'),
o AS (SELECT *, {_OUTCOME} AS outcome FROM (SELECT *, {_LINES} AS l, {_T} AS t FROM k)),
g AS (SELECT conv_id, turn, {_S} = '' AS empty, coalesce(string_agg(CASE WHEN outcome = 'fail' THEN name END, '; ' ORDER BY name), '') AS failed, count(CASE WHEN outcome = 'not_applicable' THEN 1 END) AS na, count(*) AS n FROM o GROUP BY 1, 2, 3)
SELECT conv_id, turn, NOT empty AND failed = '' AS correct, CASE WHEN empty THEN 'empty reply' WHEN failed <> '' THEN failed END AS detail FROM g WHERE empty OR na < n""")
def format_scores(spark: SparkSession, d: str) -> DataFrame:
    rows = replies_of(spark, d)
    answer = F.expr("CASE conv_id % 5 " + " ".join(f"WHEN {k} THEN '{a}'" for k, a in enumerate(ANSWERS)) + " END")
    held = held_checks(rows, answer, spark.createDataFrame(CHECK_MAP, "param string, value string, kind string"))
    return format_score(held.withColumn("outcome", replies.checked(F.col("kind"), F.col("reply"), 40)), ["conv_id", "turn"])


@query(f"""
WITH {REPLIES_SQL}, m AS (SELECT *, 2 + conv_id % 3 AS n_options, regexp_extract({_S}, '^\\(?([A-D])', 1) AS first, regexp_extract({_S}, '^\\(?[A-D](.|\\n)?', 1) AS behind FROM replies),
p AS (SELECT *, CASE WHEN first <> '' AND ascii(first) - 64 <= n_options AND (behind = '' OR regexp_matches(behind, '[\\s.):]')) THEN first END AS letter FROM m)
SELECT conv_id, turn, letter, letter IS NOT NULL AND letter = 'B' AS correct, CASE WHEN letter IS NULL THEN 'parse_error' END AS detail FROM p""")
def option_scores(spark: SparkSession, d: str) -> DataFrame:
    """Multiple choice: the letter that a reply opens with, of as many options as there are, against the key."""
    letter = replies.option_letter(F.col("reply"), (2 + F.col("conv_id") % 3).cast("int"))
    rows = replies_of(spark, d).withColumn("letter", letter)
    return rows.select("conv_id", "turn", "letter", F.coalesce(F.col("letter") == "B", F.lit(False)).alias("correct"), F.when(F.col("letter").isNull(), "parse_error").alias("detail"))


DETAILS = (
    ("open", "choice=B"), ("open", "choice=C"), ("in_situ", "counters=true; cites=false"), ("governance", "dormant=false; update=true"), ("intrusion", "intrudes=true; evidence=a=b; c"),
    ("intrusion", "intrudes=false; evidence=none"), ("format", "length=one: pass; tone=plain: fail"), ("format", "tone=plain: not_applicable"), ("open", "empty reply"), ("in_situ", "counters=false; cites=false"),
)
_DETAILS_SQL = "details AS (SELECT * FROM (VALUES " + ", ".join(f"({k}, '{j}', '{x}')" for k, (j, x) in enumerate(DETAILS)) + ") AS t(k, judge, detail))"


@query(f"""
WITH {_DETAILS_SQL}, j AS (SELECT event_id, value > 40 AND judge <> 'intrusion' AS correct, judge, detail FROM events JOIN details ON event_id % {len(DETAILS)} = k),
f AS (SELECT event_id, correct, judge, detail, unnest(string_split(detail, '; ')) AS pair, generate_subscripts(string_split(detail, '; '), 1) AS i FROM j),
g AS (SELECT event_id, string_agg(CASE WHEN pair LIKE '%: fail' THEN left(pair, length(pair) - 6) END, '; ' ORDER BY i) AS failed, string_agg(CASE WHEN pair LIKE '%=false' THEN left(pair, length(pair) - 6) END, '; ' ORDER BY i) AS no,
  bool_and(pair LIKE '%: not_applicable') AS none FROM f GROUP BY 1)
SELECT event_id, correct, CASE WHEN detail = 'empty reply' THEN detail WHEN judge = 'format' THEN failed WHEN correct THEN NULL WHEN judge = 'open' THEN 'chose=' || substr(detail, 8)
  WHEN judge = 'intrusion' THEN 'evidence=' || substr(detail, strpos(detail, '; evidence=') + 11) ELSE coalesce(no, '') END AS detail FROM j JOIN g USING (event_id) WHERE NOT (judge = 'format' AND none)""")
def judgement_scores(spark: SparkSession, d: str) -> DataFrame:
    details = spark.createDataFrame([(k, j, x) for k, (j, x) in enumerate(DETAILS)], "k long, judge string, detail string")
    rows = table(spark, d, "events").select("event_id", "value", (F.col("event_id") % len(DETAILS)).alias("k")).join(F.broadcast(details), "k")
    score = replies.judged((F.col("value") > 40) & (F.col("judge") != "intrusion"), F.col("detail"), F.col("judge"))
    return rows.select("event_id", score.alias("s")).where("s.scored").select("event_id", "s.correct", "s.detail")


@query("SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_type END AS kind FROM events")
def rubric_cases(spark: SparkSession, d: str) -> DataFrame:
    """The case that a rubric names before its colon; null where it is not a known one."""
    rubric = F.concat_ws(": ", "event_type", "props")
    return table(spark, d, "events").select("event_id", replies.prefix_case(rubric, ("click", "view")).alias("kind"))


_NORM = "regexp_replace(lower(trim({}, ' ' || chr(9) || chr(10) || chr(13))), '\\s+', ' ', 'g')"


@query(f"""
WITH t AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'), s AS (SELECT conv_id, turn AS place, replace(lower(substr(text, 1 + turn % 5, 12)), ' ', '  ') || CASE WHEN turn % 3 = 0 THEN '?' ELSE '' END AS quote FROM t),
n AS (SELECT t.conv_id, t.turn, min(place) AS statement FROM t JOIN s ON t.conv_id = s.conv_id AND {_NORM.format('quote')} <> '' AND contains({_NORM.format('text')}, {_NORM.format('quote')}) GROUP BY 1, 2)
SELECT t.conv_id, t.turn, statement FROM (SELECT DISTINCT conv_id, turn FROM t) t LEFT JOIN n ON t.conv_id = n.conv_id AND t.turn = n.turn""")
def statement_turns(spark: SparkSession, d: str) -> DataFrame:
    """For each turn the first statement of its conversation that quotes it, whatever the case and spacing."""
    t = table(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn", "text")
    s = t.select("conv_id", F.col("turn").alias("place"), F.expr("concat(replace(lower(substr(text, 1 + turn % 5, 12)), ' ', '  '), if(turn % 3 = 0, '?', ''))").alias("quote"))
    found = first_quoting(t, s, "conv_id", "turn")
    return t.select("conv_id", "turn").distinct().join(found, ["conv_id", "turn"], "left")


def first_quoting(turns: DataFrame, statements: DataFrame, by: str, turn: str) -> DataFrame:
    """``by, turn, statement``: least ``place`` of the ``statements`` (by, place, quote) that quote a turn's text."""
    a = turns.select(by, turn, replies.normalised(F.col("text")).alias("said"))
    b = statements.select(by, "place", replies.normalised(F.col("quote")).alias("quote")).where("quote <> ''")
    return a.join(b, by).where("contains(said, quote)").groupBy(by, turn).agg(F.min("place").alias("statement"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(concat_ws(';', CASE WHEN l_returnflag = 'R' THEN 'returned' END, CASE WHEN l_discount > 0.05 THEN 'cut' END, CASE WHEN l_tax = 0 THEN 'free' END), '') AS flags, l_quantity FROM lineitem")
def joined_flags(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem")
    one = lambda when, name: F.when(F.expr(when), name)
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", replies.flags(one("l_returnflag = 'R'", "returned"), one("l_discount > 0.05", "cut"), one("l_tax = 0", "free")).alias("flags"), "l_quantity")


@query("""SELECT event_id, CASE WHEN event_type = 'error' AND user_id % 3 = 0 THEN NULL WHEN event_id % 2 = 0 THEN event_type || ' of ' || CAST(user_id AS VARCHAR) WHEN event_id % 5 = 0 THEN NULL
ELSE 'only ' || event_type END AS line FROM events""")
def rendered_templates(spark: SparkSession, d: str) -> DataFrame:
    """Lines with named slots; a slot without value, and a name that is no slot, give none."""
    template = F.expr("CASE WHEN event_id % 2 = 0 THEN '{event} of {subject}' WHEN event_id % 5 = 0 THEN '{event} at {level}' ELSE 'only {event}' END")
    event = F.expr("if(event_type = 'error' AND user_id % 3 = 0, NULL, event_type)")
    return table(spark, d, "events").select("event_id", replies.rendered(template, event=event, subject=F.col("user_id")).alias("line"))


@query("""SELECT p_partkey, '{"brand":' || to_json(p_brand) || ',"flag":' || CASE WHEN p_size > 25 THEN 'true' ELSE 'null' END || ',"size":' || CAST(p_size AS VARCHAR) || '}' AS record,
md5('{"brand":' || to_json(p_brand) || ',"flag":' || CASE WHEN p_size > 25 THEN 'true' ELSE 'null' END || ',"size":' || CAST(p_size AS VARCHAR) || '}') AS digest FROM part""")
def canonical_records(spark: SparkSession, d: str) -> DataFrame:
    """Records as JSON that is equal where the records are, whatever the order their fields were given in."""
    flag = F.when(F.col("p_size") > 25, F.lit(True))
    record = replies.canonical_json({"size": F.col("p_size"), "brand": F.col("p_brand"), "flag": flag})
    return table(spark, d, "part").select("p_partkey", record.alias("record")).withColumn("digest", F.md5(F.col("record").cast("binary")))
