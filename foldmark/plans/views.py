"""Public views and replay plans, what was known on a day, JSON in one form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.functions import json, numbers
from foldmark.operators import rank
from foldmark.operators.views import AsOf, assembled, shown
from foldmark.plans.registry import query, rounded, table
from foldmark.sources import tables


@query("""
WITH o AS (SELECT o_custkey, list({'o_orderdate': strftime(o_orderdate, '%Y-%m-%d'), 'o_orderkey': o_orderkey} ORDER BY o_orderdate, o_orderkey) AS sessions FROM orders GROUP BY 1),
p AS (SELECT o_custkey, list('q_' || substr(sha256('run:' || CAST(o_orderkey AS VARCHAR)), 1, 16) ORDER BY o_orderkey) AS probes FROM orders WHERE o_orderkey % 10 = 0 GROUP BY 1)
SELECT c_custkey, c_mktsegment, coalesce(len(sessions), 0) AS n_sessions, coalesce(array_to_string(list_transform(sessions, lambda s: s.o_orderdate || '#' || s.o_orderkey), ','), '') AS sessions, coalesce(array_to_string(probes, ','), '') AS probes
FROM customer LEFT JOIN o ON o_custkey = c_custkey LEFT JOIN p ON p.o_custkey = c_custkey""")
def replay_plans(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's public view: profile, sessions in time order, probes under opaque ids; no hidden column in it."""
    hidden = set(tables.TABLES["customer"].hidden) | {"o_totalprice"}
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    sessions = orders.select("c_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderkey")
    probes = orders.where("o_orderkey % 10 = 0").select("c_custkey", "o_orderkey", rank.opaque_id("run", "o_orderkey").alias("probe"))
    subjects = tables.public("customer", table(spark, d, "customer")).select("c_custkey", "c_mktsegment")
    found = assembled(subjects, {"sessions": (sessions, ["o_orderdate", "o_orderkey"]), "probes": (probes, ["o_orderkey"])}, "c_custkey", hidden, orders)
    # customers without an order are subjects, too
    idle = subjects.join(orders, "c_custkey", "left_anti")
    said = F.array_join(F.transform("sessions", lambda s: F.concat(s["o_orderdate"], F.lit("#"), s["o_orderkey"].cast("string"))), ",")
    out = found.select("c_custkey", "c_mktsegment", F.size("sessions").cast("long").alias("n_sessions"), said.alias("sessions"), F.array_join("probes.probe", ",").alias("probes"))
    return shown(out.unionByName(idle.select("*", F.lit(0).cast("long").alias("n_sessions"), F.lit("").alias("sessions"), F.lit("").alias("probes"))), hidden)


@query("""
WITH e AS (SELECT * FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-17')
SELECT s.event_type, s.n, s.latest, u.buyers FROM (SELECT event_type, count(*) AS n, arg_max(event_id, (ts, event_id)) AS latest FROM e GROUP BY 1) s CROSS JOIN (SELECT count(DISTINCT user_id) AS buyers FROM e WHERE event_type = 'purchase') u""")
def known_on_day(spark: SparkSession, d: str) -> DataFrame:
    """What tools may tell on a day: every source bound by it, checked in the plan."""
    known = AsOf("2024-01-17", {"events": (table(spark, d, "events"), "ts")})
    e = known.read("events")
    latest = e.groupBy("event_type").agg(F.count("*").alias("n"), F.max_by("event_id", F.struct("ts", "event_id")).alias("latest"))
    buyers = known.read("events").where("event_type = 'purchase'").agg(F.count_distinct("user_id").alias("buyers"))
    return known.checked(latest.crossJoin(F.broadcast(buyers)))


@query("""
SELECT c_custkey, '{"a":{"b":' || c_nationkey || ',"z":"' || c_mktsegment || '"},"list":[{"k":1,"n":null},{"k":' || c_custkey || ',"n":"x"}],"map":{"one":1},"z":null}' AS json FROM customer""")
def canonical_json(spark: SparkSession, d: str) -> DataFrame:
    """Nested records in one form, their names sorted at every depth."""
    item = lambda n, k: F.struct(n.cast("string").alias("n"), k.cast("long").alias("k"))
    nested = F.struct(
        F.lit(None).cast("string").alias("z"), F.create_map(F.lit("one"), F.lit(1)).alias("map"), F.array(item(F.lit(None), F.lit(1)), item(F.lit("x"), F.col("c_custkey"))).alias("list"),
        F.struct(F.col("c_mktsegment").alias("z"), F.col("c_nationkey").alias("b")).alias("a"),
    )
    rows = table(spark, d, "customer").select("c_custkey", nested.alias("r"))
    return rows.select("c_custkey", json.canonical(F.col("r"), rows.schema["r"].dataType).alias("json"))


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"a": {"b": {"c": {"d": ' || event_id || '}}}, "s": "}{"}' WHEN 1 THEN props WHEN 2 THEN props END AS block FROM events""")
def last_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The last block of a reply: deep, after an earlier one, after an unclosed one, or none."""
    deep = F.concat(F.lit('so: {"a": {"b": {"c": {"d": '), F.col("event_id").cast("string"), F.lit('}}}, "s": "}{"} end }'))
    kind = F.col("event_id") % 4
    said = F.when(kind == 0, deep).when(kind == 1, F.concat(F.lit('{"first": 1} then '), "props")).when(kind == 2, F.concat(F.lit("an { open one, then "), "props", F.lit(" it's"))).otherwise("none { here")
    return table(spark, d, "events").select("event_id", json.last_block(said).alias("block"))


@query("""
SELECT event_id, round(0.7 * value + 0.3 * user_id, 6) AS mean, round((0.7 * value + 0.3 * user_id) / sqrt(0.7 * 0.7 + 0.3 * 0.3), 6) AS unit, round(CASE WHEN value > 0 THEN log10(value + 1) ELSE 0 END, 6) AS size FROM events""")
def forecast_blends(spark: SparkSession, d: str) -> DataFrame:
    """The mean of two forecasts, the same at unit variance, and a size that grows with the logarithm of coverage."""
    mean, unit = numbers.blend(F.col("value"), F.col("user_id"), F.lit(0.3))
    size = F.when(F.col("value") > 0, F.log10(F.col("value") + 1)).otherwise(0.0)
    return rounded(table(spark, d, "events").select("event_id", mean.alias("mean"), unit.alias("unit"), size.alias("size")), "mean", "unit", "size")
