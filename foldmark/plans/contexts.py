"""Contexts, selections and summaries composed of several tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldmark.functions import replies
from foldmark.operators import asof, overlap
from foldmark.operators import evidence as ev
from foldmark.plans.registry import query, rounded, table
from foldmark.plans.signals import Tables, _sql
from foldmark.plans.texts import _GRAMS_SQL, _grams


def selected(rows: DataFrame, **criteria: object) -> DataFrame:
    """Rows that meet all criteria that are given: a list of values for a column, or a least value; None asks nothing."""
    for name, wanted in criteria.items():
        if isinstance(wanted, (list, tuple, set)):
            rows = rows.where(F.col(name).isin(*wanted))
        elif wanted is not None:
            rows = rows.where(F.col(name) >= wanted)
    return rows


@query("SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal >= 0")
def selected_subjects(spark: SparkSession, d: str) -> DataFrame:
    return selected(table(spark, d, "customer"), c_mktsegment=("BUILDING", "MACHINERY"), c_acctbal=0, c_nationkey=None).select("c_custkey", "c_nationkey", "c_mktsegment")


RULES = (("stop", "subject", True, "pnl"), ("age", "subject", False, "days"), ("level", "idea", True, "price"), ("event", "idea", False, "date"))
_RULES_SQL = "rules AS (SELECT n_nationkey AS subject, (n_nationkey * 37) % 200 AS idea, r.* FROM nation, (VALUES " + ", ".join(f"('{n}', '{s}', {str(x).lower()}, '{f}')" for n, s, x, f in RULES) + ") AS r(rule, scope, daily, field))"


def applicable(rules: DataFrame, positions: DataFrame) -> DataFrame:
    """Rules that apply to a position today: daily ones of its whole subject, and those of its own idea."""
    mine = rules.withColumnRenamed("idea", "rule_idea")
    return positions.join(mine, "subject").where("(scope = 'subject' AND daily) OR (scope = 'idea' AND rule_idea = idea)").drop("rule_idea")


@query(f"""WITH {_RULES_SQL}, p AS (SELECT DISTINCT s_nationkey AS subject, l_partkey % 200 AS idea FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_quantity > 48)
SELECT p.subject, p.idea, rule, field FROM p JOIN rules r ON r.subject = p.subject AND (scope = 'subject' AND daily OR scope = 'idea' AND r.idea = p.idea)""")
def applicable_rules(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "rule string, scope string, daily boolean, field string")
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("subject"), (F.col("n_nationkey") * 37 % 200).alias("idea")).crossJoin(F.broadcast(rules))  # a stated list
    p = table(spark, d, "lineitem").where("l_quantity > 48").join(table(spark, d, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    p = p.select(F.col("s_nationkey").alias("subject"), (F.col("l_partkey") % 200).alias("idea")).distinct()
    return applicable(n, p).select("subject", "idea", "rule", "field")


@query("""WITH x AS (SELECT l_suppkey, count(DISTINCT l_partkey) AS held, max(l_shipdate) AS last FROM lineitem WHERE l_quantity > 40 GROUP BY 1), m AS (SELECT max(l_shipdate) AS horizon FROM lineitem)
SELECT l_suppkey, held, CASE WHEN held >= 110 THEN 'full' WHEN held >= 90 + l_suppkey % 20 THEN 'nothing left' WHEN last > horizon - INTERVAL 5 DAY THEN 'too late' END AS blocked FROM x, m""")
def structural_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Why a book can take no new position: it is full, its universe is used up, or the horizon is near."""
    x = table(spark, d, "lineitem")
    held = x.where("l_quantity > 40").groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("held"), F.max("l_shipdate").alias("last"))
    horizon = x.agg(F.max("l_shipdate").alias("horizon"))
    why = F.when(F.col("held") >= 110, "full").when(F.col("held") >= 90 + F.col("l_suppkey") % 20, "nothing left").when(F.col("last") > F.col("horizon") - F.expr("INTERVAL 5 DAY"), "too late")
    return held.crossJoin(F.broadcast(horizon)).select("l_suppkey", "held", why.alias("blocked"))


def items(rows: DataFrame, judges: dict[str, tuple[Column, list[tuple[str, Column]]]]) -> DataFrame:
    """Rows for each judge that looks at them, with the first reason to skip them (null: to be judged)."""
    out = None
    for judge, (which, skips) in judges.items():
        reason = F.lit(None).cast("string")
        for name, when in reversed(skips):
            reason = F.when(when, name).otherwise(reason)
        part = rows.where(which).withColumn("judge", F.lit(judge)).withColumn("reason", reason)
        out = part if out is None else out.unionByName(part)
    return out


@query("""
WITH p AS (SELECT conv_id, turn, coalesce(text, '') AS text, conv_id % 3 AS k FROM conversations WHERE role = 'assistant'), j AS (
SELECT 'open' AS judge, CASE WHEN text = '' THEN 'empty' WHEN length(text) > 900 THEN 'too long' END AS reason FROM p WHERE k = 0 UNION ALL SELECT 'in_situ', CASE WHEN text = '' THEN 'empty' END FROM p WHERE k = 1
UNION ALL SELECT 'format', CASE WHEN turn % 4 = 1 THEN 'no values' END FROM p WHERE k > 0)
SELECT judge, coalesce(reason, 'judged') AS reason, count(*) AS n FROM j GROUP BY 1, 2""")
def judge_items(spark: SparkSession, d: str) -> DataFrame:
    """Which replies need which judge, and why the others do not, in counts."""
    p = table(spark, d, "conversations").where("role = 'assistant'").select("turn", F.coalesce("text", F.lit("")).alias("text"), (F.col("conv_id") % 3).alias("k"))
    empty = ("empty", F.col("text") == "")
    found = items(p, {"open": (F.col("k") == 0, [empty, ("too long", F.char_length("text") > 900)]), "in_situ": (F.col("k") == 1, [empty]), "format": (F.col("k") > 0, [("no values", F.col("turn") % 4 == 1)])})
    return found.groupBy("judge", F.coalesce("reason", F.lit("judged")).alias("reason")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, coalesce(CASE WHEN p_size = 7 THEN 'rule of ' || p_brand END, CASE WHEN l_returnflag = 'R' THEN 'closed at ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END, 'for ' || c_mktsegment, 'none') AS note
FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0 LEFT JOIN part ON p_partkey = l_partkey WHERE o_orderstatus = 'F'""")
def trade_notes(spark: SparkSession, d: str) -> DataFrame:
    """A note for each trade: its rule's, else its position's, else its idea's, else none."""
    x = table(spark, d, "lineitem").join(table(spark, d, "orders").where("o_orderstatus = 'F'"), F.col("o_orderkey") == F.col("l_orderkey"))
    x = x.join(table(spark, d, "customer").where("c_acctbal > 0"), F.col("c_custkey") == F.col("o_custkey"), "left").join(table(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey"), "left")
    note = F.coalesce(F.expr("if(p_size = 7, concat('rule of ', p_brand), NULL)"), F.expr("if(l_returnflag = 'R', concat('closed at ', bigint(l_quantity)), NULL)"), F.expr("concat('for ', c_mktsegment)"), F.lit("none"))
    return x.select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", note.alias("note"))


@query(_sql("""SELECT s.subject, s.session, s.n, s.day, round((SELECT arg_max(p.value, p.ts) FROM e p WHERE p.user_id = s.subject AND p.event_type = 'click' AND p.day < s.day), 6) AS price, coalesce(a.list, '') AS active, coalesce(t.n, 0) AS trades
FROM (SELECT g.subject, g.session, count(*) AS n, min(g.day) AS day FROM signals g JOIN sessions k ON k.subject = g.subject AND k.session = g.session GROUP BY 1, 2) s
LEFT JOIN (SELECT subject, string_agg(trait, ',' ORDER BY trait) AS list FROM state WHERE active GROUP BY 1) a ON a.subject = s.subject
LEFT JOIN (SELECT user_id AS subject, user_id * 10 + (day(ts) - 1) // 7 AS session, count(*) AS n FROM e WHERE event_type = 'purchase' GROUP BY 1, 2) t ON t.subject = s.subject AND t.session = s.session"""), dates=("day",))
def session_contexts(spark: SparkSession, d: str) -> DataFrame:
    """What a session is about: its signals, the last price before it, active traits and its trades."""
    t = Tables(spark, d)
    s = t.signals.join(t.sessions, ["subject", "session"], "left_semi").groupBy("subject", "session").agg(F.count("*").alias("n"), F.min("day").alias("day"))
    asked = s.withColumn("ts", F.col("day").cast("timestamp") - F.expr("INTERVAL 1 MICROSECOND"))
    quotes = t.e.where("event_type = 'click'").select("subject", F.col("ts").cast("timestamp").alias("ts"), "value")
    s = asof.asof_backward(asked, quotes, "subject", "ts", "value", "price").drop("ts")
    active = ev.listed(t.state.where("active"), ["subject"], "trait", "active")
    trades = t.e.where("event_type = 'purchase'").groupBy("subject", F.expr("user_id * 10 + (day(ts) - 1) div 7").alias("session")).agg(F.count("*").alias("trades"))
    out = s.join(active, "subject", "left").join(trades, ["subject", "session"], "left").fillna({"active": "", "trades": 0})
    return rounded(out, "price")


@query(_sql("""SELECT mode, count(DISTINCT session) AS sessions, count(DISTINCT CASE WHEN valence = 'retracted' AND trait = 'error' THEN session END) AS regenerated, count(CASE WHEN valence = 'retracted' THEN 1 END) AS failures,
count(CASE WHEN session % 7 = 3 THEN 1 END) AS voided FROM signals GROUP BY 1"""))
def validation_summary(spark: SparkSession, d: str) -> DataFrame:
    """Failures, sessions that were made again (each counted once) and signals lost with dropped sessions, by mode."""
    s = Tables(spark, d).signals
    again = F.expr("if(valence = 'retracted' AND trait = 'error', session, NULL)")
    return s.groupBy("mode").agg(F.count_distinct("session").alias("sessions"), F.count_distinct(again).alias("regenerated"), F.count_if(F.expr("valence = 'retracted'")).alias("failures"), F.count_if(F.expr("session % 7 = 3")).alias("voided"))


def backed(findings: DataFrame, turns: DataFrame, revealed: DataFrame) -> DataFrame:
    """``findings`` (id, conv_id, quote, label) with ``counts``: whether the quote is in a turn of its conversation and the label was revealed."""
    said = turns.select("conv_id", replies.normalised(F.col("text")).alias("said")).join(findings.select("conv_id", "id", replies.normalised(F.col("quote")).alias("q")), "conv_id")
    quoted = said.where("q <> '' AND contains(said, q)").select("id").distinct().withColumn("quoted", F.lit(True))
    out = findings.join(quoted, "id", "left").join(F.broadcast(revealed.select("label", F.lit(True).alias("known"))), "label", "left")
    return out.withColumn("counts", F.col("quoted").isNotNull() & F.col("known").isNotNull())


@query("""
WITH f AS (SELECT conv_id * 1000 + turn AS id, conv_id, turn, CASE WHEN turn % 2 = 0 THEN substr(text, 3, 15) ELSE 'never said this' END AS quote, CASE conv_id % 3 WHEN 0 THEN 'loss' WHEN 1 THEN 'anchor' ELSE 'other' END AS label FROM conversations WHERE text IS NOT NULL),
n AS (SELECT *, regexp_replace(lower(trim(quote, ' ' || chr(9) || chr(10) || chr(13))), '\\s+', ' ', 'g') AS q FROM f)
SELECT id, label, q <> '' AND label <> 'other' AND EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = n.conv_id AND c.role = 'user' AND contains(regexp_replace(lower(trim(c.text, ' ' || chr(9) || chr(10) || chr(13))), '\\s+', ' ', 'g'), q)) AS counts FROM n""")
def backed_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Findings count only if they quote what was said and name what was revealed."""
    c = table(spark, d, "conversations")
    f = c.where("text IS NOT NULL").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "conv_id", F.expr("if(turn % 2 = 0, substr(text, 3, 15), 'never said this')").alias("quote"), F.expr("CASE conv_id % 3 WHEN 0 THEN 'loss' WHEN 1 THEN 'anchor' ELSE 'other' END").alias("label"))
    return backed(f, c.where("role = 'user'"), spark.createDataFrame([("loss",), ("anchor",)], "label string")).select("id", "label", "counts")


@query(_sql("""SELECT sha256('probe|' || CAST(subject AS VARCHAR) || '|' || trait) AS probe_id, subject, trait, CASE WHEN kind = 'bias' THEN 'presence' ELSE 'choice' END AS form, CASE WHEN kind = 'bias' THEN CASE WHEN truth_active THEN 'yes' ELSE 'no' END
ELSE chr(CAST(64 + (SELECT count(*) FROM (SELECT unnest(['held', 'low', 'high']) AS o) WHERE sha256('choice|' || CAST(subject AS VARCHAR) || '|' || trait || '|' || o) <= sha256('choice|' || CAST(subject AS VARCHAR) || '|' || trait || '|held')) AS INTEGER)) END AS answer
FROM truth WHERE kind = 'bias' OR truth_value IS NOT NULL"""))
def probe_drafts(spark: SparkSession, d: str) -> DataFrame:
    """Questions about every trait: whether a bias is there, and which of three values a preference has, in a keyed order."""
    t = Tables(spark, d).truth.where("kind = 'bias' OR truth_value IS NOT NULL")
    key = lambda o: F.sha2(F.concat_ws("|", F.lit("choice"), F.col("subject").cast("string"), "trait", o), 256)
    place = F.size(F.filter(F.array(*map(F.lit, ("held", "low", "high"))), lambda o: key(o) <= key(F.lit("held"))))
    answer = F.when(F.col("kind") == "bias", F.when(F.col("truth_active"), "yes").otherwise("no")).otherwise(F.char(F.lit(64) + place))
    return t.select(F.sha2(F.concat_ws("|", F.lit("probe"), F.col("subject").cast("string"), "trait"), 256).alias("probe_id"), "subject", "trait", F.expr("if(kind = 'bias', 'presence', 'choice')").alias("form"), answer.alias("answer"))


@query("""WITH b AS (SELECT event_id, CASE event_id % 7 WHEN 1 THEN substr(props, 1, 5) WHEN 2 THEN '{"j": 1}' WHEN 3 THEN '{"k": -4}' ELSE props END AS body FROM events)
SELECT event_id, CASE WHEN NOT json_valid(body) THEN 'not json' WHEN json_extract_string(body, '$.k') IS NULL THEN 'no k' WHEN CAST(json_extract_string(body, '$.k') AS INTEGER) NOT BETWEEN 0 AND 99 THEN 'out of range' END AS fault FROM b""")
def payload_faults(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with a body before it is kept; null for a good one."""
    body = F.expr("CASE event_id % 7 WHEN 1 THEN substr(props, 1, 5) WHEN 2 THEN '{\\\"j\\\": 1}' WHEN 3 THEN '{\\\"k\\\": -4}' ELSE props END")
    b = table(spark, d, "events").select("event_id", F.from_json(body, "k int, bad string", {"columnNameOfCorruptRecord": "bad"}).alias("x"))
    return b.select("event_id", F.when(F.col("x.bad").isNotNull(), "not json").when(F.col("x.k").isNull(), "no k").when(~F.col("x.k").between(0, 99), "out of range").alias("fault"))


@query(f"""
WITH {_GRAMS_SQL}, s AS (SELECT a.conv_id, b.conv_id AS other, count(*) AS n FROM g a JOIN g b ON a.gram = b.gram AND a.conv_id <> b.conv_id GROUP BY 1, 2), o AS (SELECT conv_id, count(*) AS own FROM g GROUP BY 1)
SELECT conv_id, own, coalesce(max(n), 0) AS shared, round(coalesce(max(n), 0) / own, 6) AS nearest FROM o LEFT JOIN s USING (conv_id) GROUP BY 1, 2""")
def nearest_other(spark: SparkSession, d: str) -> DataFrame:
    """For every transcript the greatest containment in any single other one."""
    out = overlap.nearest_other(_grams(spark, d), "conv_id")
    return rounded(out.withColumn("nearest", F.col("shared") / F.col("own")), "nearest")


@query("""
WITH c AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(CASE WHEN event_type = 'click' THEN value END) AS short, sum(CASE WHEN event_type = 'view' THEN value END) AS mid, sum(CASE WHEN event_type = 'error' THEN value END) AS long FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY 1, 2)
SELECT l.event_id, c.day AS quoted, round(short, 4) AS short, round(mid, 4) AS mid, round(long, 4) AS long FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase') l ASOF LEFT JOIN c ON c.user_id = l.user_id AND l.day >= c.day""", dates=("quoted",))
def curve_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The whole curve of the last day on which any of its tenors was quoted, at each purchase."""
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    tenor = lambda kind: F.sum(F.when(F.col("event_type") == kind, F.col("value")))
    c = e.where("event_type IN ('click', 'view', 'error')").groupBy("user_id", "day").agg(tenor("click").alias("short"), tenor("view").alias("mid"), tenor("error").alias("long"))
    c = c.select("user_id", "day", F.struct(F.col("day").alias("quoted"), "short", "mid", "long").alias("curve"))
    found = asof.asof_backward(e.where("event_type = 'purchase'").select("event_id", "user_id", "day"), c, "user_id", "day", "curve", "curve", unit="MONTH")
    return rounded(found.select("event_id", "curve.*"), "short", "mid", "long", places=4)


def nearest_in_value(rows: DataFrame, by: str, value: str, id_: str) -> DataFrame:
    """``partner``: of the others of the same ``by`` the one nearest in ``value``, of equally near ones the least ``id_``;
    null for a row without a value, and for one that is alone.

    Rows of one value are one row while neighbours are looked for; nobody is compared with all."""
    own = rows.select(F.col(by).alias("__by"), F.col(value).alias("__value"), F.col(id_).alias("__id")).where(F.col("__value").isNotNull())
    levels = own.groupBy("__by", "__value").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    second = own.join(levels, ["__by", "__value"]).where("__id > __first").groupBy("__by", "__value").agg(F.min("__id").alias("__second"))
    w = Window.partitionBy("__by").orderBy("__value")
    side = lambda step: F.struct(F.abs(step("__value").over(w) - F.col("__value")).alias("far"), step("__first").over(w).alias("id"))
    other = F.array_min(F.filter(F.array(side(F.lag), side(F.lead)), lambda x: x["far"].isNotNull()))["id"]
    levels = levels.withColumn("__other", other).join(second, ["__by", "__value"], "left")
    found = rows.join(levels, F.col(by).eqNullSafe(F.col("__by")) & (F.col(value) == F.col("__value")), "left")
    same = F.when(F.col("__first") == F.col(id_), F.col("__second")).otherwise(F.col("__first"))
    return found.select(*rows.columns, F.when(F.col("__n") > 1, same).otherwise(F.col("__other")).alias("partner"))


@query("""SELECT a.p_brand, a.p_partkey, a.p_size, arg_min(b.p_partkey, abs(a.p_size - b.p_size) * 1000000 + b.p_partkey) AS partner FROM part a LEFT JOIN part b ON a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey GROUP BY 1, 2, 3""")
def nearest_partner(spark: SparkSession, d: str) -> DataFrame:
    return nearest_in_value(table(spark, d, "part").select("p_brand", "p_partkey", "p_size"), "p_brand", "p_size", "p_partkey")


def least_other(rows: DataFrame, by: str, value: str, id_: str, held: str | None = None) -> DataFrame:
    """``partner``: of the others of the same ``by`` that are not ``held`` the one with the least ``value``, of equal ones the
    least ``id_``. Who has no value is nobody's partner, and may have one.

    The two least of each group are all that is needed, so the group is aggregated, not sorted."""
    free = F.col(value).isNotNull() if held is None else F.col(value).isNotNull() & ~F.coalesce(F.col(held), F.lit(False))
    one = rows.where(free).select(F.col(by).alias("__by"), F.struct(F.col(value).alias("value"), F.col(id_).alias("id")).alias("__s"))
    first = one.groupBy("__by").agg(F.min("__s").alias("__first"))
    second = one.join(first, "__by").where("__s > __first").groupBy("__by").agg(F.min("__s").alias("__second"))
    found = rows.join(first.join(second, "__by", "left"), F.col(by) == F.col("__by"), "left")
    return found.select(*rows.columns, F.when(F.col("__first.id") == F.col(id_), F.col("__second.id")).otherwise(F.col("__first.id")).alias("partner"))


@query("""WITH m AS (SELECT user_id, user_id % 12 AS sector, round(sum(CASE WHEN day(ts) > 20 THEN value ELSE -value / 2 END), 4) AS move FROM events GROUP BY 1)
SELECT a.user_id, a.move, (SELECT b.user_id FROM m b WHERE b.sector = a.sector AND b.user_id <> a.user_id ORDER BY b.move, b.user_id LIMIT 1) AS partner FROM m a""")
def pair_least_mover(spark: SparkSession, d: str) -> DataFrame:
    """For each subject the one of its sector that moved least."""
    m = table(spark, d, "events").groupBy("user_id").agg(F.round(F.sum(F.expr("if(day(ts) > 20, value, -value / 2)")), 4).alias("move")).withColumn("sector", F.col("user_id") % 12)
    return least_other(m, "sector", "move", "user_id").select("user_id", "move", "partner")


@query("""WITH m AS (SELECT user_id, user_id % 12 AS sector, bool_or(event_type = 'signup') AS held, CASE WHEN user_id % 7 <> 0 THEN round(sum(CASE WHEN day(ts) > 20 THEN value ELSE -value / 2 END), 4) END AS move FROM events GROUP BY 1)
SELECT a.user_id, a.move, (SELECT b.user_id FROM m b WHERE b.sector = a.sector AND b.user_id <> a.user_id AND b.move IS NOT NULL AND NOT b.held ORDER BY b.move, b.user_id LIMIT 1) AS partner FROM m a""")
def unheld_partner(spark: SparkSession, d: str) -> DataFrame:
    """The same among peers that are not held; some have no move, which makes nobody their partner."""
    move = F.round(F.sum(F.expr("if(day(ts) > 20, value, -value / 2)")), 4)
    m = table(spark, d, "events").groupBy("user_id").agg(F.expr("if(user_id % 7 <> 0, 1, NULL)").alias("on"), F.bool_or(F.col("event_type") == "signup").alias("held"), move.alias("m"))
    m = m.select("user_id", (F.col("user_id") % 12).alias("sector"), "held", F.expr("if(on IS NULL, NULL, m)").alias("move"))
    return least_other(m, "sector", "move", "user_id", "held").select("user_id", "move", "partner")


@query("""WITH x AS (SELECT event_id, CAST(ts AS DATE) + CASE WHEN hour(ts) >= 16 THEN 1 ELSE 0 END AS d FROM events) SELECT event_id, d + CASE dayofweek(d) WHEN 6 THEN 2 WHEN 0 THEN 1 ELSE 0 END AS day FROM x""", dates=("day",))
def trading_days(spark: SparkSession, d: str) -> DataFrame:
    """The session that a time belongs to: the same weekday before the close, else the next one."""
    x = table(spark, d, "events").select("event_id", F.expr("date_add(to_date(ts), if(hour(ts) >= 16, 1, 0))").alias("d"))
    return x.select("event_id", F.expr("date_add(d, CASE dayofweek(d) WHEN 7 THEN 2 WHEN 1 THEN 1 ELSE 0 END)").alias("day"))
