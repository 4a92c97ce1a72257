"""Windows, recurrences and calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldmark.functions import dates
from foldmark.operators import windows
from foldmark.plans.registry import DAILY_SQL, daily, query, rounded, table


@query(f"""
WITH {DAILY_SQL}, m AS (SELECT *, level - lag(level) OVER (PARTITION BY event_type ORDER BY t) AS move FROM indexed),
s AS (SELECT *, count(move) OVER w AS k, stddev_samp(move) OVER w AS sd_w, stddev_samp(CASE WHEN t <= 10 THEN move END) OVER (PARTITION BY event_type) AS sd_e FROM m WINDOW w AS (PARTITION BY event_type ORDER BY t ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT event_type, day, t, round(greatest(coalesce(CASE WHEN k >= 5 THEN sd_w ELSE sd_e END, 0) * sqrt(5), 1e-6), 6) AS sd FROM s""", dates=("day",))
def horizon_sd(spark: SparkSession, d: str) -> DataFrame:
    out = windows.horizon_sd(daily(spark, d), "level", "event_type", 10, 5)
    return rounded(out.select("event_type", "day", F.col("t").cast("long").alias("t"), "sd"), "sd")


@query(f"""
WITH {DAILY_SQL}
SELECT event_type, day, round(level - coalesce(lag(level, 5) OVER w, first_value(level) OVER w), 6) AS trailing,
  round(coalesce(lead(level, 5) OVER w, last_value(level) OVER (PARTITION BY event_type ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) - level, 6) AS forward FROM indexed WINDOW w AS (PARTITION BY event_type ORDER BY t)""", dates=("day",))
def trailing_forward_move(spark: SparkSession, d: str) -> DataFrame:
    days = daily(spark, d)
    return rounded(days.select("event_type", "day", windows.trailing_move("level", "event_type", 5).alias("trailing"), windows.forward_move("level", "event_type", 5).alias("forward")), "trailing", "forward")


@query(f"""
WITH {DAILY_SQL}, m AS (SELECT *, level - coalesce(lag(level, 5) OVER w, first_value(level) OVER w) AS tr, coalesce(lead(level, 5) OVER w, last_value(level) OVER (PARTITION BY event_type ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) - level AS fw,
  stddev_samp(level) OVER (PARTITION BY event_type) AS sd FROM indexed WINDOW w AS (PARTITION BY event_type ORDER BY t))
SELECT event_type, count(*) AS n, round(avg(CASE WHEN abs(tr) > sd THEN 1.0 ELSE 0.0 END), 6) AS chased, round(covar_samp(tr, fw) / nullif(stddev_samp(tr) * stddev_samp(fw), 0), 6) AS calibration FROM m GROUP BY 1""")
def extrapolation_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Share of days after a move of over one sd, and how trailing and forward moves go together."""
    from foldmark.operators.stats import correlation

    m = daily(spark, d).select("event_type", windows.trailing_move("level", "event_type", 5).alias("tr"), windows.forward_move("level", "event_type", 5).alias("fw"), F.stddev_samp("level").over(Window.partitionBy("event_type")).alias("sd"))
    out = m.groupBy("event_type").agg(F.count("*").alias("n"), F.avg(F.expr("CASE WHEN abs(tr) > sd THEN 1D ELSE 0D END")).alias("chased"), correlation("tr", "fw").alias("calibration"))
    return rounded(out, "chased", "calibration")


_RUN_SQL = "o AS (SELECT *, coalesce(value > 40, false) AS holds FROM events), i AS (SELECT *, sum(CASE WHEN holds THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM o)"


@query(f"WITH {_RUN_SQL} SELECT event_id, user_id, CAST(sum(CASE WHEN holds THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, g ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM i")
def run_counter(spark: SparkSession, d: str) -> DataFrame:
    return windows.run_counter(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("value") > 40).select("event_id", "user_id", "run")


@query(f"WITH {_RUN_SQL}, r AS (SELECT *, sum(CASE WHEN holds THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, g ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM i) SELECT user_id, count(*) AS fired, min(CAST(ts AS DATE)) AS first_fired FROM r WHERE run = 3 GROUP BY 1", dates=("first_fired",))
def rule_firings(spark: SparkSession, d: str) -> DataFrame:
    """Rules that fire when their condition has held three rows in turn, once a run."""
    runs = windows.run_counter(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("value") > 40)
    return runs.where("run = 3").groupBy("user_id").agg(F.count("*").alias("fired"), F.min(F.to_date("ts")).alias("first_fired"))


@query("""
WITH x AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), g AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS g FROM x),
r AS (SELECT user_id, g, count(*) AS days, min(day) AS first_day FROM g GROUP BY 1, 2)
SELECT user_id, days, first_day FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY days DESC, first_day) AS k FROM r) WHERE k = 1""", dates=("first_day",))
def longest_streak(spark: SparkSession, d: str) -> DataFrame:
    return windows.longest_streak(table(spark, d, "events").select("user_id", F.to_date("ts").alias("day")), "user_id", "day")


@query("""
WITH v AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS value FROM events GROUP BY 1, 2), u AS (SELECT user_id, min(day) AS a, max(day) AS b FROM v GROUP BY 1),
c AS (SELECT user_id, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM u),
f AS (SELECT c.user_id, c.day, v.value, max(v.day) OVER (PARTITION BY c.user_id ORDER BY c.day) AS known FROM c LEFT JOIN v ON c.user_id = v.user_id AND c.day = v.day)
SELECT f.user_id, f.day, round(v.value, 6) AS filled, CAST(f.day - f.known AS BIGINT) AS run FROM f JOIN v ON v.user_id = f.user_id AND v.day = f.known""", dates=("day",))
def forward_fill(spark: SparkSession, d: str) -> DataFrame:
    values = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias("value"))
    calendar = values.groupBy("user_id").agg(F.min("day").alias("a"), F.max("day").alias("b")).select("user_id", F.explode(F.sequence("a", "b")).alias("day"))
    return rounded(windows.forward_fill(calendar, values, "user_id", "day", "value"), "filled")


@query(f"""
WITH RECURSIVE {DAILY_SQL}, e(event_type, t, day, ema) AS (
  SELECT event_type, t, day, level FROM indexed WHERE t = 0
  UNION ALL SELECT i.event_type, i.t, i.day, e.ema + (1 - pow(2.0, -(i.day - e.day) / 7.0)) * (i.level - e.ema) FROM e JOIN indexed i ON i.event_type = e.event_type AND i.t = e.t + 1)
SELECT event_type, round(last(ema ORDER BY t), 6) AS ema FROM e GROUP BY 1""")
def ema_fold(spark: SparkSession, d: str) -> DataFrame:
    return rounded(windows.ema_fold(daily(spark, d), "event_type", "day", "level", 7.0), "ema")


@query(f"""
WITH {DAILY_SQL}, m AS (SELECT *, level - coalesce(lag(level, 10) OVER w, first_value(level) OVER w) AS move FROM indexed WINDOW w AS (PARTITION BY event_type ORDER BY t)),
s AS (SELECT *, stddev_samp(level) OVER (PARTITION BY event_type) AS sd FROM m)
SELECT event_type, day, round(greatest(-1, least(1, coalesce(move / nullif(sd * sqrt(10 / 252.0), 0), 0))), 6) AS trend FROM s""", dates=("day",))
def trend_score(spark: SparkSession, d: str) -> DataFrame:
    """Trailing change over its volatility, within -1 and 1."""
    m = daily(spark, d).select("event_type", "day", windows.trailing_move("level", "event_type", 10).alias("move"), F.stddev_samp("level").over(Window.partitionBy("event_type")).alias("sd"))
    return rounded(m.select("event_type", "day", F.expr("greatest(-1D, least(1D, coalesce(try_divide(move, sd * sqrt(10 / 252D)), 0D)))").alias("trend")), "trend")


@query(f"""
WITH {DAILY_SQL}, r AS (SELECT *, ln(level) - ln(lag(level) OVER (PARTITION BY event_type ORDER BY t)) AS ret, CASE WHEN day < DATE '2024-01-16' THEN 'first' ELSE 'second' END AS span FROM indexed)
SELECT event_type, span, count(ret) AS n, round(stddev_samp(ret) * sqrt(252), 6) AS vol FROM r GROUP BY 1, 2""")
def realised_vol(spark: SparkSession, d: str) -> DataFrame:
    """Annualised sd of log returns by span."""
    w = Window.partitionBy("event_type").orderBy("t")
    r = daily(spark, d).select("event_type", F.expr("if(day < date'2024-01-16', 'first', 'second')").alias("span"), (F.ln("level") - F.ln(F.lag("level").over(w))).alias("ret"))
    return rounded(r.groupBy("event_type", "span").agg(F.count("ret").alias("n"), (F.stddev_samp("ret") * float(252) ** 0.5).alias("vol")), "vol")


@query("""
WITH p AS (SELECT p_brand, p_type, p_partkey, p_retailprice FROM part), s AS (SELECT *, sum(p_retailprice) OVER (PARTITION BY p_brand) AS total, count(*) OVER (PARTITION BY p_brand) AS n FROM p)
SELECT p_partkey, round(CASE WHEN n > 1 THEN (total - p_retailprice) / (n - 1) ELSE 0 END, 4) AS peers_without, round(total / n, 4) AS peers_with FROM s""")
def peer_move(spark: SparkSession, d: str) -> DataFrame:
    """Mean of a part's brand without and with itself, from sums made before the join."""
    p = table(spark, d, "part")
    sums = p.groupBy("p_brand").agg(F.sum("p_retailprice").alias("total"), F.count("*").alias("n"))
    out = p.join(sums, "p_brand").select("p_partkey", F.expr("CASE WHEN n > 1 THEN (total - p_retailprice) / (n - 1) ELSE 0D END").alias("peers_without"), F.expr("total / n").alias("peers_with"))
    return rounded(out, "peers_without", "peers_with", places=4)


@query("""SELECT l_orderkey, round(sum(CASE WHEN l_linenumber = 1 THEN 1.0 WHEN l_returnflag = 'R' THEN -0.5 ELSE 0.5 END * p_retailprice), 4) AS level, count(*) AS legs FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def basket_level(spark: SparkSession, d: str) -> DataFrame:
    """Level of a basket: coefficients of its legs times their levels."""
    coeff = F.expr("CASE WHEN l_linenumber = 1 THEN 1D WHEN l_returnflag = 'R' THEN -0.5D ELSE 0.5D END")
    x = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rounded(x.groupBy("l_orderkey").agg(F.sum(coeff * F.col("p_retailprice")).alias("level"), F.count("*").alias("legs")), "level", places=4)


@query(f"""
WITH {DAILY_SQL}, x AS (SELECT *, lag(level) OVER (PARTITION BY event_type ORDER BY t) AS prev, pow(10, floor(log10(level))) / 2 AS grid FROM indexed)
SELECT event_type, count(*) AS days, count(CASE WHEN floor(prev / grid) <> floor(level / grid) THEN 1 END) AS crossings, count(CASE WHEN abs(level - round_even(level / grid, 0) * grid) <= 0.1 * grid THEN 1 END) AS near FROM x WHERE level > 0 GROUP BY 1""")
def round_level_tests(spark: SparkSession, d: str) -> DataFrame:
    """How often a series crosses, and comes near, half-decade round levels; ties round to even."""
    w = Window.partitionBy("event_type").orderBy("t")
    x = daily(spark, d).withColumn("prev", F.lag("level").over(w)).where("level > 0").withColumn("grid", F.expr("power(10D, floor(log10(level))) / 2"))
    return x.groupBy("event_type").agg(F.count("*").alias("days"), F.count_if(F.expr("floor(prev / grid) <> floor(level / grid)")).alias("crossings"), F.count_if(F.expr("abs(level - rint(level / grid) * grid) <= 0.1 * grid")).alias("near"))


@query("""
WITH d AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2025-12-31', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT CAST(row_number() OVER (ORDER BY day) - 1 AS BIGINT) AS t, day, CAST((day - DATE '2024-01-01') // 7 + 1 AS BIGINT) AS week,
  CAST(date_trunc('month', day) AS DATE) + CAST((5 - dayofweek(date_trunc('month', day)) + 7) % 7 + 14 AS INTEGER) AS third_friday FROM d WHERE isodow(day) < 6""", dates=("day", "third_friday",))
def weekday_axis(spark: SparkSession, d: str) -> DataFrame:
    days = dates.weekdays(spark, "2024-01-03", "2025-12-31")
    return days.select("t", "day", dates.week_of(F.col("day"), "2024-01-01").alias("week"), dates.third_friday(F.col("day")).alias("third_friday"))


@query("""
WITH x AS (SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber, l_extendedprice / l_quantity AS price, avg(l_extendedprice / l_quantity) OVER (PARTITION BY l_partkey) AS anchor FROM lineitem),
y AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS k FROM x), z AS (SELECT l_partkey, min(CASE WHEN price >= anchor THEN k END) AS first_cross, count(*) AS n FROM y GROUP BY 1)
SELECT l_partkey, n, first_cross, coalesce(first_cross <= 3, false) AS hit FROM z""")
def anchoring_first_cross(spark: SparkSession, d: str) -> DataFrame:
    """First row, in order of days, at which a series reaches its anchor."""
    x = table(spark, d, "lineitem").withColumn("price", F.col("l_extendedprice") / F.col("l_quantity"))
    anchor = x.groupBy("l_partkey").agg(F.avg("price").alias("anchor"))
    k = F.row_number().over(Window.partitionBy("l_partkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber")).cast("long")
    out = x.withColumn("k", k).join(anchor, "l_partkey").groupBy("l_partkey").agg(F.count("*").alias("n"), F.min(F.expr("if(price >= anchor, k, NULL)")).alias("first_cross"))
    return out.withColumn("hit", F.coalesce(F.col("first_cross") <= 3, F.lit(False)))
