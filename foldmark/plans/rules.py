"""Predicates, exclusions, scalar rules, audits and scoring joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldmark.functions import numbers
from foldmark.operators import rank
from foldmark.plans.registry import DAILY_SQL, daily, query, rounded, table

# rules of the form field - op - level; a level that reads as a number is compared as one
_RULES = [("r1", "c_acctbal", ">=", "5000"), ("r2", "c_mktsegment", "==", "BUILDING"), ("r3", "c_mktsegment", "in", "AUTOMOBILE|MACHINERY"), ("r4", "c_acctbal", "<", "0"), ("r5", "c_nationkey", "!=", "3")]
_RULES_SQL = "VALUES " + ", ".join(f"('{a}', '{b}', '{c}', '{d}')" for a, b, c, d in _RULES)


@query(f"""
WITH r(rule_id, field, op, level) AS ({_RULES_SQL}), f AS (SELECT c_custkey, field, CASE field WHEN 'c_acctbal' THEN CAST(c_acctbal AS VARCHAR) WHEN 'c_nationkey' THEN CAST(c_nationkey AS VARCHAR) ELSE c_mktsegment END AS v,
  CASE field WHEN 'c_acctbal' THEN c_acctbal WHEN 'c_nationkey' THEN c_nationkey END AS x, rule_id, op, level FROM customer, r)
SELECT rule_id, count(*) AS n, count(CASE WHEN CASE op WHEN '>=' THEN x >= TRY_CAST(level AS DOUBLE) WHEN '<' THEN x < TRY_CAST(level AS DOUBLE) WHEN '==' THEN coalesce(x = TRY_CAST(level AS DOUBLE), v = level)
  WHEN '!=' THEN coalesce(x <> TRY_CAST(level AS DOUBLE), v <> level) WHEN 'in' THEN list_contains(string_split(level, '|'), v) END THEN 1 END) AS holds FROM f GROUP BY 1""")
def rule_predicates(spark: SparkSession, d: str) -> DataFrame:
    """Each rule over all subjects: a few rules, exploded beside each row, and one grouping."""
    field = lambda name, text: F.when(F.col("r.field") == "c_acctbal", F.col("c_acctbal").cast(text)).when(F.col("r.field") == "c_nationkey", F.col("c_nationkey").cast(text))
    rules = F.array(*(F.struct(F.lit(a).alias("rule_id"), F.lit(b).alias("field"), F.lit(c).alias("op"), F.lit(e).alias("level")) for a, b, c, e in _RULES))
    f = table(spark, d, "customer").withColumn("r", F.explode(rules)).select("r.*", F.coalesce(field("r", "string"), F.col("c_mktsegment")).alias("v"), field("r", "double").alias("x"))
    holds = F.expr("""CASE op WHEN '>=' THEN x >= try_cast(level AS double) WHEN '<' THEN x < try_cast(level AS double) WHEN '==' THEN coalesce(x = try_cast(level AS double), v = level)
        WHEN '!=' THEN coalesce(x <> try_cast(level AS double), v <> level) WHEN 'in' THEN array_contains(split(level, '[|]'), v) END""")
    return f.groupBy("rule_id").agg(F.count("*").alias("n"), F.count_if(holds).alias("holds"))


@query("SELECT p_partkey, p_brand, p_type FROM part p WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey AND l.l_returnflag = 'R' AND l.l_discount > 0.08) AND p_size <= 25")
def universe_filter(spark: SparkSession, d: str) -> DataFrame:
    """What may be traded: the family's instruments less those that a rule excludes."""
    barred = table(spark, d, "lineitem").where("l_returnflag = 'R' AND l_discount > 0.08")
    return table(spark, d, "part").where("p_size <= 25").join(barred, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey", "p_brand", "p_type")


@query("""
SELECT c_custkey, round(least(greatest(1 / (1 + exp(-(ln(p / (1 - p)) + ln(1.5)))), 1e-6), 1 - 1e-6), 6) AS rate, round(least(greatest(0.1 * (1 + p) * CASE WHEN c_acctbal > 0 THEN sqrt(2.0) ELSE 1 / sqrt(2.0) END, 0), 1), 6) AS hazard,
  1 + CASE WHEN c_acctbal >= 1000 THEN 1 ELSE 0 END + CASE WHEN c_acctbal >= 5000 THEN 1 ELSE 0 END AS conviction, CAST(floor(c_acctbal / 100 + 0.5) AS BIGINT) AS hundreds
FROM (SELECT *, least(greatest((c_acctbal + 1000) / 11000, 1e-6), 1 - 1e-6) AS p FROM customer)""")
def scalar_rules(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").withColumn("p", F.expr("least(greatest((c_acctbal + 1000) / 11000, 1e-6D), 1 - 1e-6D)"))
    out = c.select(
        "c_custkey", numbers.regime_multiplier(F.col("p"), F.lit(1.5)).alias("rate"), numbers.sell_hazard(F.lit(0.1), F.col("p"), F.lit(2.0), F.col("c_acctbal") > 0).alias("hazard"),
        numbers.bucket(F.col("c_acctbal"), [1000, 5000]).alias("conviction"), numbers.half_up(F.col("c_acctbal") / 100).cast("long").alias("hundreds"),
    )
    return rounded(out, "rate", "hazard")


@query(f"""
WITH {DAILY_SQL}, m AS (SELECT *, level - lag(level) OVER (PARTITION BY event_type ORDER BY t) AS move FROM indexed), s AS (SELECT *, stddev_samp(move) OVER (PARTITION BY event_type) AS sd FROM m)
SELECT event_type, day, round(tanh(move / nullif(2 * sd, 0)), 6) AS surprise FROM s WHERE move IS NOT NULL AND n > 0""", dates=("day",))
def event_surprise(spark: SparkSession, d: str) -> DataFrame:
    """The move on the day over twice the sample sd of the series, through tanh."""
    w = Window.partitionBy("event_type").orderBy("t")
    m = daily(spark, d).withColumn("move", F.col("level") - F.lag("level").over(w))
    s = m.withColumn("sd", F.stddev_samp("move").over(Window.partitionBy("event_type"))).where("move IS NOT NULL")
    return rounded(s.select("event_type", "day", F.tanh(F.expr("try_divide(move, 2 * sd)")).alias("surprise")), "surprise")


@query(f"""
WITH RECURSIVE {DAILY_SQL}, z AS (SELECT event_type, t, (level - avg(level) OVER (PARTITION BY event_type)) / stddev_samp(level) OVER (PARTITION BY event_type) AS x FROM indexed),
e(event_type, t, score) AS (SELECT event_type, t, x FROM z WHERE t = 0
  UNION ALL SELECT z.event_type, z.t, CASE WHEN abs(e.score + 0.5 * (z.x - e.score)) > 1 AND abs(z.x) > 1.5 THEN -2.0 * sign(z.x) ELSE e.score + 0.5 * (z.x - e.score) END FROM e JOIN z ON z.event_type = e.event_type AND z.t = e.t + 1)
SELECT event_type, round(last(score ORDER BY t), 6) AS score FROM e GROUP BY 1""")
def street_fold(spark: SparkSession, d: str) -> DataFrame:
    """A score that eases to each day's value and is thrown to the other side where both run high."""
    whole = Window.partitionBy("event_type")
    z = daily(spark, d).select("event_type", F.struct("t", ((F.col("level") - F.avg("level").over(whole)) / F.stddev_samp("level").over(whole)).alias("x")).alias("s"))
    fold = """aggregate(slice(xs, 2, size(xs)), xs[0].x, (a, s) ->
        if(abs(a + 0.5D * (s.x - a)) > 1 AND abs(s.x) > 1.5, -2D * sign(s.x), a + 0.5D * (s.x - a)))"""
    return rounded(z.groupBy("event_type").agg(F.sort_array(F.collect_list("s")).alias("xs")).select("event_type", F.expr(fold).alias("score")), "score")


@query("""
WITH x AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events)
SELECT user_id, event_type, day FROM x WHERE k = 1""", dates=("day",))
def first_occurrences(spark: SparkSession, d: str) -> DataFrame:
    """Only the first row of each key, by an aggregate instead of a sort."""
    first = F.min_by(F.to_date("ts"), F.struct("ts", "event_id"))
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(first.alias("day"))


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20') WHERE k <= 3")
def last_rows(spark: SparkSession, d: str) -> DataFrame:
    """Up to three rows of each subject on or before a day."""
    w = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    e = table(spark, d, "events").where("to_date(ts) <= date'2024-01-20'")
    return e.withColumn("k", F.row_number().over(w)).where("k <= 3").select("user_id", "event_id")


@query("""
SELECT user_id, event_id, CASE WHEN k <= 26 THEN day || chr(CAST(96 + k AS INTEGER)) END AS session FROM (SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS k FROM events)""")
def session_numbering(spark: SparkSession, d: str) -> DataFrame:
    """The nth session of a day gets the nth letter; one beyond z is refused: it has no number."""
    w = Window.partitionBy("user_id", F.to_date("ts")).orderBy("ts", "event_id")
    return table(spark, d, "events").select("user_id", "event_id", F.when(F.row_number().over(w) <= 26, F.concat(F.to_date("ts").cast("string"), F.char(F.lit(96) + F.row_number().over(w)))).alias("session"))


@query("SELECT event_type, count(*) AS n, round(regr_slope(value, user_id), 8) AS beta FROM events GROUP BY 1")
def pooled_beta(spark: SparkSession, d: str) -> DataFrame:
    """Slope of a least-squares line over the pooled rows."""
    out = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.try_divide(F.covar_pop("value", "user_id"), F.var_pop("user_id")).alias("beta"))
    return rounded(out, "beta", places=8)


@query("""
WITH c AS (SELECT l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1), x AS (SELECT s.s_nationkey, c.l_suppkey, c.q FROM c JOIN supplier s ON s.s_suppkey = c.l_suppkey)
SELECT s_nationkey, l_suppkey, round(q, 4) AS q, lead(l_suppkey) OVER (PARTITION BY s_nationkey ORDER BY q, l_suppkey) AS partner FROM x""")
def pair_partner(spark: SparkSession, d: str) -> DataFrame:
    """The partner next in size: neighbours in order, not all pairs."""
    c = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q")).join(table(spark, d, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    w = Window.partitionBy("s_nationkey").orderBy("q", "l_suppkey")
    return rounded(c.select("s_nationkey", "l_suppkey", "q", F.lead("l_suppkey").over(w).alias("partner")), "q", places=4)


@query("""
WITH a AS (SELECT o_orderkey, o_totalprice FROM orders), b AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS total, count(*) AS n FROM lineitem GROUP BY 1)
SELECT count(*) AS orders, count(b.l_orderkey) AS with_lines, CAST(coalesce(sum(n), 0) AS BIGINT) AS lines, count(CASE WHEN abs(total - o_totalprice) <= 0.01 * o_totalprice THEN 1 END) AS within FROM a LEFT JOIN b ON a.o_orderkey = b.l_orderkey""")
def count_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    """Counters made again from the rows, beside the engine's own."""
    b = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("total"), F.count("*").alias("n"))
    x = table(spark, d, "orders").join(b, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return x.agg(F.count("*").alias("orders"), F.count("l_orderkey").alias("with_lines"), F.coalesce(F.sum("n"), F.lit(0)).alias("lines"), F.count_if(F.expr("abs(total - o_totalprice) <= 0.01 * o_totalprice")).alias("within"))


@query("""
WITH x AS (SELECT event_type, CAST(ts AS DATE) AS day, value FROM events), g AS (SELECT event_type, day - lag(day) OVER (PARTITION BY event_type ORDER BY day) AS gap FROM (SELECT DISTINCT event_type, day FROM x))
SELECT x.event_type, count(*) AS n, count(*) - count(value) AS missing, count(CASE WHEN value <= 0 THEN 1 END) AS not_positive, count(DISTINCT day) AS days, CAST(max(gap) AS BIGINT) AS longest_gap FROM x LEFT JOIN (SELECT event_type, max(gap) AS gap FROM g GROUP BY 1) g USING (event_type) GROUP BY 1""")
def data_quality(spark: SparkSession, d: str) -> DataFrame:
    """Missing and odd values, coverage and spacing of each series."""
    x = table(spark, d, "events").select("event_type", F.to_date("ts").alias("day"), "value")
    n = x.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value").isNull()).alias("missing"), F.count_if(F.col("value") <= 0).alias("not_positive"), F.count_distinct("day").alias("days"))
    days = x.select("event_type", "day").distinct()
    gap = days.withColumn("gap", F.datediff("day", F.lag("day").over(Window.partitionBy("event_type").orderBy("day")))).groupBy("event_type").agg(F.max("gap").cast("long").alias("longest_gap"))
    return n.join(gap, "event_type", "left")


@query("""
WITH r AS (SELECT doc_id, quality, toxic FROM labels), d AS (SELECT doc_id, lang FROM documents)
SELECT d.lang, count(*) AS documents, count(r.doc_id) AS judged, count(*) - count(r.doc_id) AS awaiting FROM d LEFT JOIN r USING (doc_id) GROUP BY 1""")
def awaiting(spark: SparkSession, d: str) -> DataFrame:
    """Items without a judgement yet, by kind, kinds without any at 0."""
    r = table(spark, d, "labels").select("doc_id", F.lit(1).alias("judged"))
    x = table(spark, d, "documents").select("doc_id", "lang").join(r, "doc_id", "left")
    return x.groupBy("lang").agg(F.count("*").alias("documents"), F.count("judged").alias("judged"), F.count_if(F.col("judged").isNull()).alias("awaiting"))


@query("""
SELECT user_id, CASE WHEN bool_or(event_type = 'purchase') AND bool_or(event_type = 'click') THEN 'mixed' WHEN bool_or(event_type = 'purchase') THEN 'explicit' WHEN bool_or(event_type = 'click') THEN 'implicit' ELSE 'none' END AS evidence FROM events GROUP BY 1""")
def evidence_type(spark: SparkSession, d: str) -> DataFrame:
    """Explicit, implicit, mixed or no evidence, from the set of modes."""
    e = table(spark, d, "events").groupBy("user_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("x"), F.bool_or(F.col("event_type") == "click").alias("i"))
    return e.select("user_id", F.expr("CASE WHEN x AND i THEN 'mixed' WHEN x THEN 'explicit' WHEN i THEN 'implicit' ELSE 'none' END").alias("evidence"))


@query("""
SELECT user_id, CAST(sum(json_extract_string(props, '$.k')::INTEGER) AS BIGINT) AS tokens, count(*) AS calls, round(sum(json_extract_string(props, '$.k')::INTEGER * CASE event_type WHEN 'click' THEN 0.002::DOUBLE WHEN 'view' THEN 0.001::DOUBLE END), 6) AS cost, string_agg(DISTINCT CASE WHEN event_type NOT IN ('click', 'view') THEN event_type END, ';' ORDER BY CASE WHEN event_type NOT IN ('click', 'view') THEN event_type END) AS unpriced FROM events GROUP BY 1""")
def usage_totals(spark: SparkSession, d: str) -> DataFrame:
    """Calls, tokens and cost; models without a price are listed."""
    k, price = F.expr("cast(get_json_object(props, '$.k') AS int)"), F.expr("CASE event_type WHEN 'click' THEN 0.002D WHEN 'view' THEN 0.001D END")
    out = table(spark, d, "events").groupBy("user_id").agg(
        F.sum(k).alias("tokens"), F.count("*").alias("calls"), F.sum(k * price).alias("cost"), F.array_join(F.sort_array(F.collect_set(F.expr("if(event_type NOT IN ('click', 'view'), event_type, NULL)"))), ";").alias("unpriced")
    )
    return rounded(out.withColumn("unpriced", F.when(F.col("unpriced") != "", F.col("unpriced"))), "cost")


@query("""
WITH x AS (SELECT p_partkey, len(list_filter(list_transform(string_split(p_type, ' '), lambda w: lower(w)), lambda w: w IN ('steel', 'large', 'promo', 'brushed'))) AS shared, len(string_split(p_type, ' ')) AS n, p_brand FROM part), s AS (SELECT *, shared / n AS score FROM x WHERE shared > 0)
SELECT p_brand, p_partkey, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey) AS k FROM s) WHERE k <= 3""")
def fuzzy_top(spark: SparkSession, d: str) -> DataFrame:
    """The three best of each group by share of telling words, ties by id."""
    words = F.transform(F.split("p_type", " "), F.lower)
    p = table(spark, d, "part").withColumn("score", F.size(F.filter(words, lambda w: w.isin("steel", "large", "promo", "brushed"))) / F.size(words)).where("score > 0")
    k = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.col("score").desc(), "p_partkey"))
    return rounded(p.withColumn("k", k).where("k <= 3").select("p_brand", "p_partkey", "score"), "score")


@query("""
WITH o AS (SELECT c_custkey, list_distinct([c_mktsegment, 'BUILDING', CASE WHEN c_acctbal > 0 THEN 'MACHINERY' ELSE 'BUILDING' END]) AS opts FROM customer),
e AS (SELECT c_custkey, unnest(opts) AS opt FROM o), k AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY sha256('options|' || CAST(c_custkey AS VARCHAR) || '|' || opt)) AS k FROM e)
SELECT k.c_custkey, chr(CAST(64 + k AS INTEGER)) AS answer FROM k JOIN customer c ON c.c_custkey = k.c_custkey AND c.c_mktsegment = k.opt""")
def option_assembly(spark: SparkSession, d: str) -> DataFrame:
    """Distinct outcomes in a keyed order; the answer is the letter where the true one ends up."""
    c = table(spark, d, "customer")
    opts = F.array_distinct(F.array("c_mktsegment", F.lit("BUILDING"), F.expr("if(c_acctbal > 0, 'MACHINERY', 'BUILDING')")))
    e = c.select("c_custkey", "c_mktsegment", F.explode(opts).alias("opt"))
    k = F.row_number().over(Window.partitionBy("c_custkey").orderBy(rank.keyed_order("options", "c_custkey", "opt")))
    return e.withColumn("k", k).where("c_mktsegment = opt").select("c_custkey", F.char(F.lit(64) + F.col("k")).alias("answer"))


@query("""
WITH w AS (SELECT l_suppkey, count(*) AS n, count(DISTINCT l_orderkey) AS cap FROM lineitem GROUP BY 1)
SELECT l_suppkey, n, cap, sha256(CAST(l_suppkey AS VARCHAR) || ':' || CAST(n AS VARCHAR)) AS request_key, n > cap AS over FROM w""")
def request_keys(spark: SparkSession, d: str) -> DataFrame:
    """Content-addressed keys of requests: equal requests are asked once."""
    w = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_distinct("l_orderkey").alias("cap"))
    return w.select("l_suppkey", "n", "cap", F.sha2(F.concat_ws(":", F.col("l_suppkey").cast("string"), F.col("n").cast("string")), 256).alias("request_key"), (F.col("n") > F.col("cap")).alias("over"))


@query("""
WITH t AS (SELECT conv_id, max(CASE WHEN role = 'user' THEN turn END) AS asked, max(CASE WHEN role = 'assistant' THEN turn END) AS answered, count(*) AS n, count(DISTINCT turn) AS turns FROM conversations GROUP BY 1)
SELECT conv_id, n, coalesce(answered > asked, false) AS answered_last, n = turns AS turns_differ, n BETWEEN 2 AND 8 AS length_ok FROM t""")
def transcript_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Row constraints of transcripts as named columns; unknown counts as broken."""
    turn = lambda role: F.max(F.when(F.col("role") == role, F.col("turn")))
    t = table(spark, d, "conversations").groupBy("conv_id").agg(turn("user").alias("asked"), turn("assistant").alias("answered"), F.count("*").alias("n"), F.count_distinct("turn").alias("turns"))
    return t.select("conv_id", "n", F.coalesce(F.col("answered") > F.col("asked"), F.lit(False)).alias("answered_last"), (F.col("n") == F.col("turns")).alias("turns_differ"), F.col("n").between(2, 8).alias("length_ok"))


@query()
def copula_draws(spark: SparkSession, d: str) -> DataFrame:
    """Correlated activation strengths: keyed normals, mixed by fixed weights, as log-normal marginals."""
    c = table(spark, d, "customer").select("c_custkey")
    clip = lambda purpose: F.least(F.greatest(rank.uniform(purpose, "c_custkey"), F.lit(1e-12)), F.lit(1 - 1e-12))
    z1, z2 = (numbers.normal_quantile(clip(p)) for p in ("loss", "gain"))
    return rounded(c.select("c_custkey", F.exp(0.5 * z1).alias("loss"), F.exp(0.5 * (0.6 * z1 + 0.8 * z2)).alias("gain")), "loss", "gain")
