"""Estimates, cells, tests and verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldmark.operators import cells, pooled, stats
from foldmark.plans.registry import query, rounded, table

_ESTIMATES = """est AS (
  SELECT s.s_suppkey, s.s_acctbal AS planted, s.s_acctbal > 5000 AS active, n.n_regionkey, avg(CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END) AS value, count(l_orderkey) AS n
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN lineitem l ON l.l_suppkey = s.s_suppkey GROUP BY ALL)"""


def _estimates(spark: SparkSession, d: str) -> DataFrame:
    """Share of discounted lines by supplier; the balance plays the planted strength."""
    shares = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.avg(F.when(F.col("l_discount") > 0.05, 1.0).otherwise(0.0)).alias("value"), F.count("l_orderkey").alias("n"))
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.join(shares, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(
        "s_suppkey", F.col("s_acctbal").alias("planted"), (F.col("s_acctbal") > 5000).alias("active"), "n_regionkey", "value", F.coalesce("n", F.lit(0)).alias("n")
    )


@query(f"""
WITH {_ESTIMATES},
m AS (SELECT *, 'pool' AS kind, 'all' AS cell FROM est UNION ALL SELECT *, 'region', CAST(n_regionkey AS VARCHAR) FROM est),
c AS (SELECT kind, cell, count(CASE WHEN NOT active THEN value END) AS n_neutral, count(CASE WHEN active THEN value END) AS n_active, count(*) - count(value) AS n_missing,
  avg(CASE WHEN NOT active THEN value END) AS neutral_mean, stddev_samp(CASE WHEN NOT active THEN value END) AS neutral_sd,
  avg(CASE WHEN active THEN value END) AS active_mean, stddev_samp(CASE WHEN active THEN value END) AS active_sd FROM m GROUP BY 1, 2),
f AS (SELECT *, neutral_mean + 2 * neutral_sd AS floor FROM c),
p AS (SELECT kind, cell, avg(CASE WHEN value > floor THEN 1.0 WHEN floor IS NOT NULL THEN 0.0 END) AS share_past_floor FROM m JOIN f USING (kind, cell) WHERE active AND value IS NOT NULL GROUP BY 1, 2),
z AS (SELECT f.*, share_past_floor, (active_mean - neutral_mean) / nullif(sqrt(neutral_sd * neutral_sd / nullif(n_neutral, 0) + active_sd * active_sd / nullif(n_active, 0)), 0) AS pop_z FROM f LEFT JOIN p USING (kind, cell))
SELECT kind, cell, n_neutral, n_active, n_missing, round(neutral_mean, 6) AS neutral_mean, round(neutral_sd, 6) AS neutral_sd, round(active_mean, 6) AS active_mean, round(floor, 6) AS floor,
  round(share_past_floor, 6) AS share_past_floor, round(pop_z, 6) AS pop_z,
  coalesce(active_mean > neutral_mean AND neutral_sd <= 0.5 * abs(active_mean - neutral_mean), false) AS gap_ok, coalesce(pop_z >= 3, false) AS pop_ok,
  CASE WHEN n_neutral < 5 OR n_active < 5 THEN 'insufficient' WHEN coalesce(pop_z >= 3, false) THEN 'pass' ELSE 'fail' END AS verdict FROM z""")
def gate_cells(spark: SparkSession, d: str) -> DataFrame:
    out = cells.gate_cells(cells.memberships(_estimates(spark, d), {"region": "n_regionkey"}))
    return rounded(out, "neutral_mean", "neutral_sd", "active_mean", "floor", "share_past_floor", "pop_z")


@query("""
WITH r AS (SELECT event_type, rank() OVER (PARTITION BY event_type ORDER BY value) + (count(*) OVER (PARTITION BY event_type, value) - 1) / 2.0 AS rx,
  rank() OVER (PARTITION BY event_type ORDER BY user_id) + (count(*) OVER (PARTITION BY event_type, user_id) - 1) / 2.0 AS ry FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL)
SELECT event_type, count(*) AS n, round(CASE WHEN count(*) >= 3 THEN covar_samp(rx, ry) / nullif(stddev_samp(rx) * stddev_samp(ry), 0) END, 6) AS rho FROM r GROUP BY 1""")
def spearman_by_type(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.spearman(table(spark, d, "events"), ["event_type"], "value", "user_id"), "rho")


@query("""
WITH x AS (SELECT l.l_suppkey, o.o_orderpriority, o.o_orderdate, l.l_extendedprice - p.p_retailprice * l.l_quantity AS gain, l.l_returnflag = 'R' AS sold
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey),
days AS (SELECT DISTINCT l_suppkey, o_orderdate FROM x WHERE sold), y AS (SELECT x.* FROM x SEMI JOIN days USING (l_suppkey, o_orderdate))
SELECT l_suppkey, count(*) AS n, round((sum(CASE WHEN sold AND gain > 0 THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN gain > 0 THEN 1 ELSE 0 END), 0))
  / nullif(sum(CASE WHEN sold AND gain < 0 THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN gain < 0 THEN 1 ELSE 0 END), 0), 0), 6) AS disposition FROM y GROUP BY 1""")
def disposition(spark: SparkSession, d: str) -> DataFrame:
    """Share of gains that are sold over that of losses, on the days on which a subject sells anything."""
    x = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    x = x.select("l_suppkey", "o_orderdate", (F.col("l_extendedprice") - F.col("p_retailprice") * F.col("l_quantity")).alias("gain"), (F.col("l_returnflag") == "R").alias("sold"))
    sold, n = F.max("sold").over(Window.partitionBy("l_suppkey", "o_orderdate")), lambda c: F.count_if(F.expr(c))
    rate = lambda sign: F.try_divide(n(f"sold AND gain {sign} 0"), n(f"gain {sign} 0"))
    out = x.withColumn("selling", sold).where("selling").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.try_divide(rate(">"), rate("<")).alias("disposition"))
    return rounded(out, "disposition")


@query("""
SELECT l_suppkey, count(CASE WHEN l_returnflag <> 'N' THEN 1 END) AS n_loss, round(count(CASE WHEN l_returnflag = 'R' THEN 1 END) / nullif(count(CASE WHEN l_returnflag <> 'N' THEN 1 END), 0), 6) AS loss_share,
  round(count(CASE WHEN l_linestatus = 'F' AND l_quantity < 10 THEN 1 END) / nullif(count(CASE WHEN l_linestatus = 'F' THEN 1 END), 0), 6) AS exit_share,
  round(count(CASE WHEN (l_discount > 0.05) = (l_tax > 0.04) AND l_discount <> 0.05 THEN 1 END) / nullif(count(CASE WHEN l_discount <> 0.05 THEN 1 END), 0), 6) AS herding_share,
  round(avg(CASE WHEN l_extendedprice BETWEEN 1000 * l_quantity AND 2000 * l_quantity THEN 1.0 ELSE 0.0 END), 6) AS coverage_share FROM lineitem GROUP BY 1""")
def share_estimators(spark: SparkSession, d: str) -> DataFrame:
    """Filtered ratios with the number they are of; null where that is 0."""
    of = lambda hit, every: F.try_divide(F.count_if(F.expr(hit)), F.count_if(F.expr(every)))
    out = table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.count_if(F.expr("l_returnflag <> 'N'")).alias("n_loss"), of("l_returnflag = 'R'", "l_returnflag <> 'N'").alias("loss_share"),
        of("l_linestatus = 'F' AND l_quantity < 10", "l_linestatus = 'F'").alias("exit_share"),
        of("(l_discount > 0.05) = (l_tax > 0.04) AND l_discount <> 0.05", "l_discount <> 0.05").alias("herding_share"),
        F.avg(F.expr("CASE WHEN l_extendedprice BETWEEN 1000 * l_quantity AND 2000 * l_quantity THEN 1D ELSE 0D END")).alias("coverage_share"),
    )
    return rounded(out, "loss_share", "exit_share", "herding_share", "coverage_share")


@query("""SELECT l_linestatus, l_returnflag, round(quantile_cont(n, 0.1), 6) AS p10, bool_or(n < 2) AS shortfall
FROM (SELECT l_linestatus, l_returnflag, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def opportunity_p10(spark: SparkSession, d: str) -> DataFrame:
    """Tenth percentile (linear) of the subjects' numbers of opportunities, and whether any falls short."""
    n = table(spark, d, "lineitem").groupBy("l_linestatus", "l_returnflag", "l_suppkey").agg(F.count("*").alias("n"))
    return rounded(n.groupBy("l_linestatus", "l_returnflag").agg(F.expr("percentile(n, 0.1)").alias("p10"), F.bool_or(F.col("n") < 2).alias("shortfall")), "p10")


_SPLITS = "CASE WHEN CAST(ts AS DATE) < DATE '2024-01-11' THEN 'early' WHEN CAST(ts AS DATE) < DATE '2024-01-21' THEN 'middle' ELSE 'late' END"


@query(f"""
WITH drift AS (SELECT user_id, min(ts) AS drifted FROM events WHERE event_type = 'signup' GROUP BY 1),
e AS (SELECT e.*, {_SPLITS} AS regime, d.drifted FROM events e LEFT JOIN drift d USING (user_id)),
s AS (SELECT user_id, value, 'all' AS split FROM e WHERE drifted IS NULL UNION ALL SELECT user_id, value, regime FROM e UNION ALL SELECT user_id, value, CASE WHEN ts < drifted THEN 'before' ELSE 'after' END FROM e WHERE drifted IS NOT NULL)
SELECT split, count(DISTINCT user_id) AS subjects, count(*) AS n, round(avg(value), 6) AS mean_value FROM s GROUP BY 1""")
def split_fanout(spark: SparkSession, d: str) -> DataFrame:
    """Each row in every split that it belongs to: all (subjects without a drift), its regime, before or after the drift."""
    e = table(spark, d, "events")
    drift = e.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("drifted"))
    splits = F.array_compact(F.array(F.expr("if(drifted IS NULL, 'all', NULL)"), F.expr(_SPLITS), F.expr("CASE WHEN drifted IS NULL THEN NULL WHEN ts < drifted THEN 'before' ELSE 'after' END")))
    rows = e.join(drift, "user_id", "left").select("user_id", "value", F.explode(splits).alias("split"))
    return rounded(rows.groupBy("split").agg(F.count_distinct("user_id").alias("subjects"), F.count("*").alias("n"), F.avg("value").alias("mean_value")), "mean_value")


_FISHER_SQL = """list_sum(list_transform(range(greatest(hits, present - n_inactive, 0), least(n_active, present) + 1), lambda k:
  exp(lgamma(n_active + 1) - lgamma(k + 1) - lgamma(n_active - k + 1) + lgamma(n_inactive + 1) - lgamma(present - k + 1) - lgamma(n_inactive - present + k + 1)
  - lgamma(n_active + n_inactive + 1) + lgamma(present + 1) + lgamma(n_active + n_inactive - present + 1))))"""


@query(f"""
WITH c AS (SELECT n_nationkey, count(CASE WHEN c_acctbal > 4000 THEN 1 END) AS n_active, count(CASE WHEN c_acctbal <= 4000 THEN 1 END) AS n_inactive,
  count(CASE WHEN c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY' THEN 1 END) AS present, count(CASE WHEN c_acctbal > 4000 AND (c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY') THEN 1 END) AS hits
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT n_nationkey, n_active, n_inactive, hits, round(least(1.0, coalesce({_FISHER_SQL}, 0)), 6) AS p FROM c""")
def fisher_upper(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    there = "(c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY')"
    n = c.groupBy("n_nationkey").agg(*(F.count_if(F.expr(e)).alias(k) for k, e in {"n_active": "c_acctbal > 4000", "n_inactive": "c_acctbal <= 4000", "present": there, "hits": f"c_acctbal > 4000 AND {there}"}.items()))
    return rounded(n.withColumn("p", stats.fisher_upper("hits", "n_active", "n_inactive", "present")), "p").drop("present")


@query("""
WITH r AS (SELECT s_nationkey, list(CASE WHEN s_acctbal > 5000 THEN 0.25 ELSE 0.5 END ORDER BY s_suppkey) AS ps, count(CASE WHEN s_acctbal > 2000 THEN 1 END) AS hits FROM supplier GROUP BY 1),
x AS (SELECT s_nationkey, hits, len(ps) AS n, list_reduce(list_prepend([1.0::DOUBLE], list_transform(ps, lambda p: [p::DOUBLE])),
  lambda d, q: list_transform(range(1, len(d) + 2), lambda i: coalesce(d[i], 0) * (1 - q[1]) + CASE WHEN i > 1 THEN coalesce(d[i - 1], 0) * q[1] ELSE 0 END)) AS dist FROM r)
SELECT s_nationkey, hits, n, round(least(1.0, list_sum(dist[hits + 1:])), 6) AS p FROM x""")
def poisson_binomial(spark: SparkSession, d: str) -> DataFrame:
    """Tail of the number of hits of suppliers with unequal chances, by nation."""
    tries = table(spark, d, "supplier").select("s_nationkey", F.expr("CASE WHEN s_acctbal > 5000 THEN 0.25D ELSE 0.5D END").alias("chance"), (F.col("s_acctbal") > 2000).alias("hit"))
    # equal chances are counted, so no list of tries is made
    equal = tries.groupBy("s_nationkey", "chance").agg(F.count("*").alias("n"), F.count_if("hit").alias("hits"))
    r = equal.groupBy("s_nationkey").agg(F.sum("hits").alias("hits"), F.sum("n").alias("tries"), F.collect_list(F.struct("chance", "n")).alias("mix"))
    return rounded(r.select("s_nationkey", "hits", F.col("tries").alias("n"), pooled.upper_tail_column(F.col("mix"), F.col("hits")).alias("p")), "p")


@query("""
WITH x AS (SELECT lang, quality = 1 AS truth, n_chars > 1000 AS said FROM labels JOIN documents USING (doc_id) WHERE quality IS NOT NULL AND n_chars IS NOT NULL),
c AS (SELECT lang, count(*) AS n, count(CASE WHEN truth THEN 1 END) AS a, count(CASE WHEN NOT truth THEN 1 END) AS b, count(CASE WHEN truth AND said THEN 1 END) AS tp, count(CASE WHEN NOT truth AND NOT said THEN 1 END) AS tn FROM x GROUP BY 1)
SELECT lang, n, tp + tn AS n_positive, round((tp / nullif(a, 0) + tn / nullif(b, 0)) / 2, 6) AS rate, CASE WHEN least(a, b) < 2 THEN 'insufficient' WHEN (tp / nullif(a, 0) + tn / nullif(b, 0)) / 2 > 0.5 THEN 'pass' ELSE 'fail' END AS verdict FROM c""")
def confusion_cells(spark: SparkSession, d: str) -> DataFrame:
    """Balanced rate of a prediction by language; insufficient with under two of either class."""
    x = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id").where("quality IS NOT NULL AND n_chars IS NOT NULL")
    n = x.groupBy("lang").agg(F.count("*").alias("n"), *(F.count_if(F.expr(e)).alias(k) for k, e in {"a": "quality = 1", "b": "NOT (quality = 1)", "tp": "quality = 1 AND n_chars > 1000", "tn": "NOT (quality = 1) AND NOT (n_chars > 1000)"}.items()))
    n = n.withColumn("rate", F.expr("(try_divide(tp, a) + try_divide(tn, b)) / 2")).withColumn("verdict", F.expr("CASE WHEN least(a, b) < 2 THEN 'insufficient' WHEN rate > 0.5 THEN 'pass' ELSE 'fail' END"))
    return rounded(n.select("lang", "n", F.expr("tp + tn").alias("n_positive"), "rate", "verdict"), "rate")


@query("""
WITH x AS (SELECT source, quality, CASE WHEN n_chars > 600 THEN 1 ELSE 0 END AS said FROM labels JOIN documents USING (doc_id) WHERE quality IS NOT NULL),
y AS (SELECT source, count(*) AS n, avg(CASE WHEN quality = said THEN 1.0 ELSE 0.0 END) AS po, avg(quality) * avg(said) + (1 - avg(quality)) * (1 - avg(said)) AS pe FROM x GROUP BY 1)
SELECT source, n, round(po, 6) AS agreement, round((po - pe) / nullif(1 - pe, 0), 6) AS kappa FROM y""")
def kappa(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id").where("quality IS NOT NULL").withColumn("said", F.expr("CASE WHEN n_chars > 600 THEN 1 ELSE 0 END"))
    return rounded(stats.kappa(x, ["source"], "quality", "said"), "agreement", "kappa")


@query("""
WITH x AS (SELECT d.lang, d.source, l.quality = 1 AS correct, l.toxic = 1 AS present, d.n_chars FROM labels l JOIN documents d USING (doc_id)),
s AS (SELECT 'lang' AS dimension, lang AS slice, correct, present FROM x UNION ALL SELECT 'source', source, correct, present FROM x UNION ALL SELECT 'size', CASE WHEN n_chars < 1000 THEN 'short' ELSE 'long' END, correct, present FROM x UNION ALL SELECT 'all', 'all', correct, present FROM x)
SELECT dimension, slice, count(*) AS n, round(avg(CASE WHEN correct THEN 1.0 ELSE 0.0 END), 6) AS accuracy, 0.5::DOUBLE AS chance,
  round((count(CASE WHEN correct AND present THEN 1 END) / nullif(count(CASE WHEN present THEN 1 END), 0) + count(CASE WHEN correct AND NOT present THEN 1 END) / nullif(count(CASE WHEN NOT present THEN 1 END), 0)) / 2, 6) AS balanced FROM s GROUP BY 1, 2""")
def score_summary(spark: SparkSession, d: str) -> DataFrame:
    """Accuracy, chance and balanced accuracy over several dimensions of slices at once."""
    x = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id").select("lang", "source", (F.col("quality") == 1).alias("correct"), (F.col("toxic") == 1).alias("present"), "n_chars")
    dims = F.expr("array(named_struct('dimension', 'lang', 'slice', lang), named_struct('dimension', 'source', 'slice', source), named_struct('dimension', 'size', 'slice', if(n_chars < 1000, 'short', 'long')), named_struct('dimension', 'all', 'slice', 'all'))")
    of = lambda hit, every: F.try_divide(F.count_if(F.expr(hit)), F.count_if(F.expr(every)))
    out = x.select("correct", "present", F.inline(dims)).groupBy("dimension", "slice").agg(
        F.count("*").alias("n"), F.avg(F.when(F.col("correct"), 1.0).otherwise(0.0)).alias("accuracy"), F.lit(0.5).alias("chance"),
        ((of("correct AND present", "present") + of("correct AND NOT present", "NOT present")) / 2).alias("balanced"),
    )
    return rounded(out, "accuracy", "balanced")


@query("""
WITH x AS (SELECT o_custkey, o_orderdate, o_totalprice, quantile_cont(o_totalprice, 0.9) OVER (PARTITION BY o_custkey) AS bar FROM orders)
SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n, round(sum(o_totalprice), 4) AS total FROM x WHERE o_totalprice >= bar GROUP BY 1, 2""", dates=("day",))
def percentile_days(spark: SparkSession, d: str) -> DataFrame:
    """Days on which a subject's orders reach its own ninetieth percentile (linear, inclusive)."""
    o = table(spark, d, "orders")
    bar = o.groupBy("o_custkey").agg(F.expr("percentile(o_totalprice, 0.9)").alias("bar"))
    out = o.join(bar, "o_custkey").where("o_totalprice >= bar").groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    return rounded(out, "total", places=4)


@query("""
WITH r AS (SELECT l_suppkey, rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_suppkey, l_quantity) - 1) / 2.0 AS rx,
  rank() OVER (PARTITION BY l_suppkey ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_suppkey, l_discount) - 1) / 2.0 AS ry FROM lineitem)
SELECT l_suppkey, count(*) AS n, round(1 - CASE WHEN count(*) >= 3 THEN covar_samp(rx, ry) / nullif(stddev_samp(rx) * stddev_samp(ry), 0) END, 6) AS conviction FROM r GROUP BY 1""")
def conviction(spark: SparkSession, d: str) -> DataFrame:
    """One less the rank correlation of size and stated conviction; null under three or where one is constant."""
    rho = stats.spearman(table(spark, d, "lineitem"), ["l_suppkey"], "l_quantity", "l_discount")
    return rounded(rho.select("l_suppkey", "n", (1 - F.col("rho")).alias("conviction")), "conviction")
