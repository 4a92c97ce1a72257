"""Sources and sinks: what is written comes back, checks of keys and invariants, series as arrays and rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.operators import machine
from foldmark.plans.registry import daily, query, rounded, table
from foldmark.sources import tables


def _place(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/foldmark-tables/{name}-{uuid.uuid4().hex[:12]}"


@query("SELECT kind, c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 9 = 1 THEN '' WHEN c_custkey % 9 = 2 THEN 'a \"b\", c' ELSE c_mktsegment END AS c_mktsegment FROM customer, (SELECT unnest(['csv', 'json', 'parquet']) AS kind)")
def round_trips(spark: SparkSession, d: str) -> DataFrame:
    """Customers, some without a segment or an odd one, written in each format and read again with their schema."""
    odd = F.expr("CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 9 = 1 THEN '' WHEN c_custkey % 9 = 2 THEN 'a \"b\", c' ELSE c_mktsegment END")
    c = table(spark, d, "customer").select(*(F.col(n).cast(t) for n, t in (x.split() for x in tables.TABLES["customer"].schema.split(", ")))).withColumn("c_mktsegment", odd)
    t, out = tables.TABLES["customer"], None
    for kind in ("parquet", "json", "csv"):
        path = _place(spark, kind)
        if kind == "csv":
            back = tables.read_csv(spark, t.schema, tables.write_csv(c, path))
        else:
            back = tables.read(spark, t, tables.write(c, t, path, kind), kind)
        back = back.withColumn("kind", F.lit(kind))
        out = back if out is None else out.unionByName(back)
    return out


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return tables.duplicate_keys(table(spark, d, "lineitem"), ("l_orderkey", "l_linenumber"))


@query("""SELECT event_id, concat_ws(';', CASE WHEN NOT coalesce(value > 5, false) THEN 'large enough' END, CASE WHEN NOT coalesce(event_type <> 'error' OR user_id > 20, false) THEN 'errors of the old' END) AS broken FROM events
WHERE NOT coalesce(value > 5, false) OR NOT coalesce(event_type <> 'error' OR user_id > 20, false)""")
def broken_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Rows that break a stated rule of their table, whose schema is that of the frame, with the rules' names."""
    e = table(spark, d, "events")
    t = tables.derived(e, "events", ("event_id",), invariants={"large enough": "value > 5", "errors of the old": "event_type <> 'error' OR user_id > 20"})
    return tables.violations(e, t).select("event_id", F.array_join("broken", ";").alias("broken"))


@query("""WITH x AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(CAST(event_id AS DOUBLE) / 4 AS VARCHAR) END AS level FROM events)
SELECT event_id, TRY_CAST(level AS DOUBLE) AS level_num, CASE WHEN TRY_CAST(level AS DOUBLE) IS NULL THEN level END AS level_text, level FROM x""")
def mixed_levels(spark: SparkSession, d: str) -> DataFrame:
    """A column of numbers and words in two typed columns, and back."""
    x = table(spark, d, "events").select("event_id", F.expr("if(event_id % 3 = 0, event_type, cast(cast(event_id AS double) / 4 AS string))").alias("level"))
    split = tables.split_mixed(x, "level")
    return tables.join_mixed(split.withColumns({"n": F.col("level_num"), "t": F.col("level_text")}), "level").withColumnsRenamed({"n": "level_num", "t": "level_text"})


@query("""WITH t AS (SELECT event_type, CAST(ts AS DATE) AS day, sum(value) AS level FROM events WHERE day(ts) % 5 <> 2 GROUP BY 1, 2)
SELECT event_type, day, round(level, 4) AS level, day - min(day) OVER (PARTITION BY event_type) AS place FROM t""", dates=("day",))
def series_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Series as arrays by day, with holes, and as rows again; each row with its place in the array."""
    days = daily(spark, d).where("day(day) % 5 <> 2").select("event_type", "day", "level")
    arrays = tables.day_arrays(days, "event_type", "day", "level")
    back = tables.day_rows(arrays, "event_type", "day", "level").join(arrays.select("event_type", "first"), "event_type")
    return rounded(back.select("event_type", "day", "level", F.datediff("day", "first").cast("long").alias("place")), "level", places=4)


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE event_type <> 'view' OR value > 50 GROUP BY 1")
def part_folders(spark: SparkSession, d: str) -> DataFrame:
    """A folder for each type of event; one of them is written anew, the others stay."""
    e, path = table(spark, d, "events").select("event_id", "event_type", "value"), _place(spark, "parts")
    tables.append_parts(e, "event_type", path)
    tables.append_parts(e.where("event_type = 'view' AND value > 50"), "event_type", path)
    return rounded(spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")), "total", places=4)


@query("""WITH x AS (SELECT event_id, user_id, ts, CASE WHEN value > 120 THEN 1 WHEN value < 15 THEN 0 END AS turn FROM events),
s AS (SELECT *, count(turn) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM x), a AS (SELECT event_id, user_id, ts, coalesce(max(turn) OVER (PARTITION BY user_id, g), 0) AS armed FROM s)
SELECT event_id, armed FROM (SELECT *, lag(armed, 1, 0) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old FROM a) WHERE armed <> old""")
def alarm_changes(spark: SparkSession, d: str) -> DataFrame:
    """An alarm that a high value sets and only a low one clears: the events at which it changes, folded in order."""

    def step(armed, row):
        now = 1 if row.value > 120 else 0 if row.value < 15 else armed
        return now, ((row.event_id, now) if now != armed else None)

    return machine.fold(table(spark, d, "events").select("user_id", "ts", "event_id", "value"), "user_id", ["ts", "event_id"], "event_id long, armed int", int, step)
