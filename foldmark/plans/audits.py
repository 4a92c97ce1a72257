"""Counts and spacing of a calendar, coverage of a map of checks, bare shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.operators import audits
from foldmark.plans.registry import query, rounded, table


@query("""
WITH e AS (SELECT event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 2 AS odd FROM events), x AS (SELECT event_type, count(*) AS n FROM e WHERE event_type <> 'signup' GROUP BY 1 UNION ALL SELECT 'merger', 2),
t AS (SELECT event_type, count(*) AS n FROM e WHERE event_type <> 'error' OR odd = 1 GROUP BY 1)
SELECT event_type, coalesce(x.n, 0) AS target, coalesce(t.n, 0) AS realised, coalesce(x.n, 0) = coalesce(t.n, 0) AS passed FROM x FULL JOIN t USING (event_type)""")
def calendar_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events of each kind against the numbers drawn: one kind lost some, one was never drawn, one never came."""
    e = table(spark, d, "events").withColumn("odd", F.expr("cast(regexp_extract(props, '([0-9]+)', 1) AS bigint) % 2"))
    drawn = e.where("event_type <> 'signup'").groupBy("event_type").agg(F.count("*").alias("n")).unionByName(spark.createDataFrame([("merger", 2)], "event_type string, n long"))
    return audits.count_metrics(e.where("event_type <> 'error' OR odd = 1"), drawn, "event_type")


@query("""
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'signup' AND user_id % 5 <> 0), g AS (SELECT *, day - lag(day) OVER (PARTITION BY user_id ORDER BY day) AS gap FROM d),
a AS (SELECT user_id, count(*) AS n, min(gap) AS smallest_gap, max(gap) AS largest_gap FROM g GROUP BY 1)
SELECT u.user_id, coalesce(n, 0) AS n, CAST(7 AS BIGINT) AS least, coalesce(n, 0) >= 7 AS covered, smallest_gap, largest_gap FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN a USING (user_id)""")
def report_spacing(spark: SparkSession, d: str) -> DataFrame:
    """Reports of each subject: enough of them, and the days between; some have none."""
    e = table(spark, d, "events")
    return audits.spacing_metrics(e.where("event_type = 'signup' AND user_id % 5 <> 0"), e, "user_id", "ts", 52, 7, "WEEK")


@query("""
WITH c AS (SELECT DISTINCT p_type AS param, p_brand AS value FROM part), m AS (SELECT DISTINCT p_type AS param, CASE WHEN p_size > 48 THEN p_brand || 'x' ELSE p_brand END AS value, CASE WHEN p_size = 7 THEN 'odd' ELSE 'table' END AS kind FROM part WHERE p_type <> 'PROMO' AND p_size % 7 = 0)
SELECT DISTINCT param, NULL AS value, 'no entry for the parameter' AS fault FROM c WHERE param NOT IN (SELECT param FROM m) UNION ALL
SELECT param, value, 'no entry for the value' FROM c WHERE param IN (SELECT param FROM m) AND NOT EXISTS (SELECT 1 FROM m WHERE m.param = c.param AND m.value = c.value) UNION ALL
SELECT param, value, 'not in the catalogue' FROM m WHERE NOT EXISTS (SELECT 1 FROM c WHERE m.param = c.param AND m.value = c.value) UNION ALL SELECT param, value, 'unknown kind: ' || kind FROM m WHERE kind = 'odd'""")
def check_map_faults(spark: SparkSession, d: str) -> DataFrame:
    """Where a map of checks and the catalogue of values do not cover each other."""
    part = table(spark, d, "part")
    entries = part.where("p_type <> 'PROMO' AND p_size % 7 = 0").select(F.col("p_type").alias("param"), F.expr("if(p_size > 48, concat(p_brand, 'x'), p_brand)").alias("value"), F.expr("if(p_size = 7, 'odd', 'table')").alias("kind"))
    return audits.map_faults(part.select(F.col("p_type").alias("param"), F.col("p_brand").alias("value")), entries.distinct(), ["table", "bullets"])


@query("""
WITH x AS (SELECT 'all' AS slice, 'all' AS slice_value, c_acctbal FROM customer UNION ALL SELECT 'segment', c_mktsegment, c_acctbal FROM customer UNION ALL SELECT 'nation', CAST(c_nationkey AS VARCHAR), c_acctbal FROM customer)
SELECT slice, slice_value, count(*) AS n, count(CASE WHEN c_acctbal > 5000 THEN 1 END) AS n_positive, round(count(CASE WHEN c_acctbal > 5000 THEN 1 END) / count(*), 6) AS rate FROM x GROUP BY 1, 2""")
def recovery_shares(spark: SparkSession, d: str) -> DataFrame:
    return rounded(audits.share_cells(table(spark, d, "customer"), {"segment": "c_mktsegment", "nation": "c_nationkey"}, "c_acctbal > 5000"), "rate")
