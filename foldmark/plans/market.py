"""Indices, calendars, generated paths and picks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldmark.functions import numbers
from foldmark.operators import rank
from foldmark.plans.registry import DAILY_SQL, daily, query, rounded, table


@query("""
WITH x AS (SELECT event_type, CAST(ts AS DATE) AS day, avg(ln(value)) AS mean_of_logs, ln(avg(value)) AS log_of_mean FROM events WHERE value > 0 GROUP BY 1, 2)
SELECT event_type, day, round(mean_of_logs - lag(mean_of_logs) OVER w, 6) AS index_move, round(log_of_mean - lag(log_of_mean) OVER w, 6) AS credit_move FROM x WINDOW w AS (PARTITION BY event_type ORDER BY day)""", dates=("day",))
def family_index(spark: SparkSession, d: str) -> DataFrame:
    """Moves of an equal-weight index: the mean of logs, and for spreads the log of the mean."""
    x = table(spark, d, "events").where("value > 0").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.avg(F.ln("value")).alias("a"), F.ln(F.avg("value")).alias("b"))
    w = Window.partitionBy("event_type").orderBy("day")
    return rounded(x.select("event_type", "day", (F.col("a") - F.lag("a").over(w)).alias("index_move"), (F.col("b") - F.lag("b").over(w)).alias("credit_move")), "index_move", "credit_move")


@query(f"""
WITH {DAILY_SQL}, p AS (SELECT t, max(CASE WHEN event_type = 'click' THEN level END) AS a, max(CASE WHEN event_type = 'view' THEN level END) AS b FROM indexed GROUP BY 1),
m AS (SELECT a - lag(a) OVER (ORDER BY t) AS a, b - lag(b) OVER (ORDER BY t) AS b FROM p), c AS (SELECT count(a + b) AS n, covar_samp(a, b) / nullif(stddev_samp(a) * stddev_samp(b), 0) AS r FROM m)
SELECT n, round(r, 6) AS r, abs(atanh(r) - atanh(0.1)) <= 3 / sqrt(n - 3) AS within FROM c""")
def correlation_check(spark: SparkSession, d: str) -> DataFrame:
    """Realised against implied correlation on Fisher's scale, within three standard errors."""
    from foldmark.operators.stats import correlation

    p = daily(spark, d).groupBy("t").agg(*(F.max(F.when(F.col("event_type") == e, F.col("level"))).alias(k) for k, e in (("a", "click"), ("b", "view"))))
    w = Window.orderBy("t")  # one row a day, whatever the number of events
    m = p.select((F.col("a") - F.lag("a").over(w)).alias("a"), (F.col("b") - F.lag("b").over(w)).alias("b"))
    c = m.agg(F.count(F.col("a") + F.col("b")).alias("n"), correlation("a", "b").alias("r"))
    return rounded(c.withColumn("within", F.expr("abs(atanh(r) - atanh(0.1D)) <= 3 / sqrt(n - 3)")), "r")


@query("""
SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, printf('ti_%03d', row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber)) AS idea_id, l_orderkey, l_linenumber FROM lineitem""", dates=("day",))
def idea_ids(spark: SparkSession, d: str) -> DataFrame:
    """Zero-padded counters that restart with each subject and never truncate."""
    k = F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber"))
    return table(spark, d, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("day"), F.format_string("ti_%03d", k).alias("idea_id"), "l_orderkey", "l_linenumber")


@query("""
WITH q AS (SELECT p_brand, p_partkey, sha256('situation|' || CAST(p_partkey AS VARCHAR)) AS k FROM part WHERE p_size > 20 AND p_retailprice > 910)
SELECT p_brand, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY k) AS n FROM q) WHERE n = 1""")
def situations(spark: SparkSession, d: str) -> DataFrame:
    """The first qualifying instrument of each group in a keyed random order."""
    q = table(spark, d, "part").where("p_size > 20 AND p_retailprice > 910")
    return q.groupBy("p_brand").agg(F.min_by("p_partkey", rank.keyed_order("situation", "p_partkey")).alias("p_partkey"))


@query("""
WITH e AS (SELECT event_type, CAST(ts AS DATE) AS day, sum(CASE WHEN value > 90 THEN (value - 90) / 10 ELSE 0 END) AS jump FROM events GROUP BY 1, 2), w AS (SELECT day, sum(jump) AS market FROM e WHERE event_type = 'error' GROUP BY 1)
SELECT e.event_type, e.day, round(e.jump + coalesce(CASE WHEN e.event_type <> 'error' THEN w.market END, 0), 6) AS jump FROM e LEFT JOIN w USING (day)""", dates=("day",))
def event_jumps(spark: SparkSession, d: str) -> DataFrame:
    """Own jumps of each series and day, and the market-wide ones that all others share."""
    jump = F.sum(F.expr("if(value > 90, (value - 90) / 10, 0D)"))
    e = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(jump.alias("own"))
    market = e.where("event_type = 'error'").select("day", F.col("own").alias("market"))
    out = e.join(market, "day", "left").select("event_type", "day", (F.col("own") + F.coalesce(F.expr("if(event_type <> 'error', market, NULL)"), F.lit(0.0))).alias("jump"))
    return rounded(out, "jump")


@query("""
WITH s AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS k FROM conversations WHERE role = 'user'), a AS (SELECT conv_id, count(*) AS n FROM conversations WHERE role = 'assistant' GROUP BY 1)
SELECT s.conv_id, length(text) AS last_question_chars, coalesce(a.n, 0) AS answers, coalesce(a.n, 0) = 0 AS pending FROM s LEFT JOIN a USING (conv_id) WHERE k = 1""")
def pending_answers(spark: SparkSession, d: str) -> DataFrame:
    """The last question of each transcript, and whether it has any answer: what a rerun still has to ask."""
    c = table(spark, d, "conversations")
    asked = c.where("role = 'user'").groupBy("conv_id").agg(F.max_by(F.length("text"), F.struct("turn", "role", "text")).cast("long").alias("last_question_chars"))
    answers = c.where("role = 'assistant'").groupBy("conv_id").agg(F.count("*").alias("n"))
    return asked.join(answers, "conv_id", "left").select("conv_id", "last_question_chars", F.coalesce("n", F.lit(0)).alias("answers"), (F.coalesce("n", F.lit(0)) == 0).alias("pending"))


@query("""
WITH x AS (SELECT event_id, user_id, event_type, value, avg(value) OVER (PARTITION BY event_type) AS m, stddev_samp(value) OVER (PARTITION BY event_type) AS s FROM events)
SELECT event_type, count(*) AS n, count(CASE WHEN s IS NULL OR s = 0 THEN 1 END) AS flat, count(CASE WHEN abs(value - m) <= 2 * s THEN 1 END) AS inside, CASE WHEN count(*) < 5 THEN 'insufficient' WHEN count(CASE WHEN abs(value - m) <= 2 * s THEN 1 END) >= 0.9 * count(*) THEN 'pass' ELSE 'fail' END AS verdict FROM x GROUP BY 1""")
def interval_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Share of values inside two sds of their kind, judged; the statistics are made before the join, not in one window."""
    e = table(spark, d, "events")
    s = e.groupBy("event_type").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"))
    x = e.join(F.broadcast(s) if s.count() <= 100_000 else s, "event_type")
    n = x.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.expr("s IS NULL OR s = 0")).alias("flat"), F.count_if(F.expr("abs(value - m) <= 2 * s")).alias("inside"))
    return n.withColumn("verdict", F.expr("CASE WHEN n < 5 THEN 'insufficient' WHEN inside >= 0.9D * n THEN 'pass' ELSE 'fail' END"))


#: parts of one task of the paths, each of which becomes a row for every weekday
_PATHS = 5000


@query()
def market_paths(spark: SparkSession, d: str) -> DataFrame:
    """Log-price paths of parts over the 260 weekdays of 52 weeks: a shared factor and own noise from keyed normals,
    summed in a window per instrument; nothing depends on the order of rows or partitions.

    The factor is drawn once for each day. Parts are dealt out before they become paths, so no path is shuffled."""
    from foldmark.functions.dates import weekdays

    z = lambda u: numbers.normal_quantile(F.least(F.greatest(F.col(u), F.lit(1e-12)), F.lit(1 - 1e-12)))
    days = weekdays(spark, "2024-01-01", "2024-12-27").withColumn("u", rank.uniform("factor", "t")).withColumn("factor", z("u"))
    days = days.select(F.struct("t", F.col("day").cast("string").alias("day"), "factor").alias("x")).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    parts = table(spark, d, "part").select("p_partkey", "p_retailprice")
    parts = parts.repartition(max(spark.sparkContext.defaultParallelism, parts.count() // _PATHS + 1), "p_partkey")
    grid = parts.crossJoin(F.broadcast(days)).select("p_partkey", "p_retailprice", F.explode("xs").alias("x")).select("p_partkey", "p_retailprice", "x.*")
    # a draw is a column of its own: within the quantile it would be made anew wherever that names it
    steps = grid.withColumn("u", rank.uniform("own", "p_partkey", "t")).withColumn("step", 0.01 * (0.6 * F.col("factor") + 0.8 * z("u")))
    w = Window.partitionBy("p_partkey").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = steps.withColumn("price", F.col("p_retailprice") * F.exp(F.sum("step").over(w)))
    return rounded(out.select("p_partkey", "t", "day", "price"), "price")
