"""Quoted levels: confirmed by the market as of the day, or by any number that a turn's tools returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.functions import text
from foldmark.operators import asof
from foldmark.plans.registry import query, rounded, table

# what one of a unit is in the common one; a unit of another name confirms nothing
SCALES = {"one": 1.0, "percent": 0.01, "bp": 0.0001}
_UNIT_SQL = "CASE event_id % 4 WHEN 0 THEN 'one' WHEN 1 THEN 'percent' WHEN 2 THEN 'bp' ELSE 'lots' END"
_SAID_SQL = "value * CASE event_id % 4 WHEN 1 THEN 100 WHEN 2 THEN 10000 ELSE 1 END"


@query(f"""
WITH q AS (SELECT event_type, CAST(ts AS DATE) AS day, max(value) AS high, avg(value) AS mean FROM events WHERE day(ts) % 3 = 1 GROUP BY ALL),
u AS (SELECT event_type, 'high' AS field, day, high AS level FROM q UNION ALL SELECT event_type, 'mean', day, mean * 100 * 0.01 FROM q),
m AS (SELECT event_id, event_type, CASE WHEN event_id % 2 = 0 THEN 'high' ELSE 'mean' END AS field, CAST(ts AS DATE) AS day, {_UNIT_SQL} AS unit, {_SAID_SQL} AS said FROM events),
s AS (SELECT *, CASE unit WHEN 'one' THEN said WHEN 'percent' THEN said * 0.01 WHEN 'bp' THEN said * 0.0001 END AS v FROM m),
a AS (SELECT s.*, u.level FROM s ASOF LEFT JOIN u ON s.event_type = u.event_type AND s.field = u.field AND s.day >= u.day)
SELECT event_id, field, unit, round(level, 6) AS reference, coalesce(abs(v - level) <= 0.25 * greatest(abs(level), 1e-9), false) AS confirmed FROM a""")
def level_confirmation(spark: SparkSession, d: str) -> DataFrame:
    """What is said of a series on a day, in its own unit, against the last quote of that field on or before the day."""
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    daily = e.where("day(ts) % 3 = 1").groupBy("event_type", "day").agg(F.max("value").alias("high"), F.avg("value").alias("mean"))
    quotes = daily.select("event_type", "day", F.lit("high").alias("field"), F.lit("one").alias("unit"), F.col("high").alias("value"))
    quotes = quotes.unionByName(daily.select("event_type", "day", F.lit("mean").alias("field"), F.lit("percent").alias("unit"), (F.col("mean") * 100).alias("value")))
    unit = F.element_at(F.array(*map(F.lit, ("one", "percent", "bp", "lots"))), (F.col("event_id") % 4 + 1).cast("int"))
    said = F.col("value") * F.expr("CASE event_id % 4 WHEN 1 THEN 100D WHEN 2 THEN 10000D ELSE 1D END")
    mentions = e.select("event_id", "event_type", F.expr("if(event_id % 2 = 0, 'high', 'mean')").alias("field"), "day", unit.alias("unit"), said.alias("value"))
    found = asof.confirmed_by_market(mentions, quotes, ["event_type", "field"], SCALES, 0.25)
    return rounded(found.select("event_id", "field", "unit", "reference", "confirmed"), "reference")


@query("""
WITH n AS (SELECT user_id, CAST(regexp_extract(props, '(-?[0-9.]+)', 1) AS DOUBLE) AS x FROM events WHERE props IS NOT NULL)
SELECT event_id, user_id, EXISTS (SELECT 1 FROM n WHERE n.user_id = e.user_id AND abs(e.value - n.x) <= 0.01 * greatest(abs(n.x), 1e-9)) AS confirmed FROM events e""")
def tool_confirmation(spark: SparkSession, d: str) -> DataFrame:
    """Numbers said by a subject, each confirmed if any number in the JSON of its tools' results is within a hundredth."""
    e = table(spark, d, "events")
    numbers = e.select("user_id", F.explode(text.numbers_in(F.col("props"))).alias("value"))
    return asof.confirmed_by_any(e.select("event_id", "user_id", "value"), numbers, ["user_id"], "value", 0.01).select("event_id", "user_id", "confirmed")


@query("""
WITH c AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice AS v FROM lineitem WHERE l_returnflag = 'R'), o AS (SELECT DISTINCT l_suppkey, l_extendedprice AS v FROM lineitem WHERE l_returnflag = 'A')
SELECT l_suppkey, count(*) AS said, count(CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.l_suppkey = c.l_suppkey AND abs(c.v - o.v) <= 0.0001 * greatest(abs(o.v), 1e-9)) THEN 1 END) AS confirmed FROM c GROUP BY 1""")
def confirmed_prices(spark: SparkSession, d: str) -> DataFrame:
    """How many prices of returned items of each supplier a price of its accepted ones confirms; no pairs of items."""
    x = table(spark, d, "lineitem").withColumn("v", F.col("l_extendedprice"))
    found = asof.confirmed_by_any(x.where("l_returnflag = 'R'").select("l_suppkey", "v"), x.where("l_returnflag = 'A'").select("l_suppkey", "v"), ["l_suppkey"], "v", 0.0001)
    return found.groupBy("l_suppkey").agg(F.count("*").alias("said"), F.count_if("confirmed").alias("confirmed"))
