"""As-of, interval, tolerance, semi and anti joins; set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldmark.operators import asof, machine
from foldmark.plans.registry import query, rounded, table


@query("""
SELECT l.event_id, l.user_id, round(r.value, 6) AS last_click FROM (SELECT * FROM events WHERE event_type = 'purchase') l
ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'click' GROUP BY 1, 2) r ON l.user_id = r.user_id AND l.ts >= r.ts""")
def asof_backward(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return rounded(asof.asof_backward(left, e.where("event_type = 'click'").select("user_id", "ts", "value"), "user_id", "ts", "value", "last_click").drop("ts"), "last_click")


@query("""
SELECT l.event_id, l.user_id, CAST(min(r.ts) AS DATE) AS next_error FROM (SELECT * FROM events WHERE event_type = 'purchase') l LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') r ON l.user_id = r.user_id AND r.ts > l.ts GROUP BY 1, 2""", dates=("next_error",))
def asof_forward(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").where("event_type IN ('purchase', 'error')")
    rows = asof.paired_with_next(rows, "user_id", "ts", F.col("event_type") == "error", "next_error")
    return rows.where("event_type = 'purchase'").select("event_id", "user_id", F.to_date("next_error").alias("next_error"))


@query("""
WITH base AS (SELECT user_id, arg_min(value, event_id) AS value FROM events GROUP BY 1)
SELECT l.event_id, round(coalesce(r.value, b.value), 6) AS trait FROM (SELECT * FROM events WHERE event_type = 'purchase') l JOIN base b USING (user_id)
ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'signup' GROUP BY 1, 2) r ON l.user_id = r.user_id AND l.ts >= r.ts""")
def trait_value_asof(spark: SparkSession, d: str) -> DataFrame:
    """A base value, and dated updates of it: the value that holds at each purchase."""
    e = table(spark, d, "events")
    base = e.groupBy("user_id").agg(F.min_by("value", "event_id").alias("base"))
    found = asof.asof_backward(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), e.where("event_type = 'signup'").select("user_id", "ts", "value"), "user_id", "ts", "value", "update")
    return rounded(found.join(base, "user_id").select("event_id", F.coalesce("update", "base").alias("trait")), "trait")


@query("""
SELECT regime, event_type, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT *, CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-14' THEN 'risk_on' WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-22' THEN 'range' ELSE 'burn_in' END AS regime FROM events) GROUP BY 1, 2""")
def interval_regime(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    e = asof.interval_join(e, [("risk_on", "2024-01-05", "2024-01-14"), ("range", "2024-01-15", "2024-01-22")], "day", "regime", "burn_in")
    return rounded(e.groupBy("regime", "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")), "total", places=4)


@query("""
SELECT o.event_id, o.user_id, CAST(o.ts AS DATE) AS dormant_from, CAST(min(c.ts) AS DATE) AS revived FROM (SELECT * FROM events WHERE event_type = 'error') o
LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') c ON c.user_id = o.user_id AND c.ts > o.ts GROUP BY 1, 2, o.ts""", dates=("dormant_from", "revived",))
def dormancy_windows(spark: SparkSession, d: str) -> DataFrame:
    """Each start of dormancy with the first later revival."""
    rows = table(spark, d, "events").where("event_type IN ('error', 'signup')")
    rows = asof.paired_with_next(rows, "user_id", "ts", F.col("event_type") == "signup", "revived")
    return rows.where("event_type = 'error'").select("event_id", "user_id", F.to_date("ts").alias("dormant_from"), F.to_date("revived").alias("revived"))


@query("""
WITH a AS (SELECT l_orderkey, l_partkey, l_extendedprice AS v FROM lineitem), b AS (SELECT l_orderkey, l_partkey, l_extendedprice * (1 + CASE WHEN l_tax > 0.04 THEN 0.02 ELSE 0.001 END) AS v FROM lineitem)
SELECT 'left' AS side, l_orderkey, l_partkey, round(v, 4) AS v FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.l_orderkey = a.l_orderkey AND b.l_partkey = a.l_partkey AND abs(a.v - b.v) <= 0.005 * abs(b.v))
UNION ALL SELECT 'right', l_orderkey, l_partkey, round(v, 4) FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE b.l_orderkey = a.l_orderkey AND b.l_partkey = a.l_partkey AND abs(b.v - a.v) <= 0.005 * abs(a.v))""")
def tolerance_anti(spark: SparkSession, d: str) -> DataFrame:
    """Rows of either side that the other does not confirm within half a percent."""
    x = table(spark, d, "lineitem")
    a = x.select("l_orderkey", "l_partkey", F.col("l_extendedprice").alias("v"))
    b = x.select("l_orderkey", "l_partkey", (F.col("l_extendedprice") * (1 + F.expr("if(l_tax > 0.04, 0.02D, 0.001D)"))).alias("v"))
    keys = ["l_orderkey", "l_partkey"]
    out = asof.tolerance_anti(a, b, keys, "v", 0.005).withColumn("side", F.lit("left")).unionByName(asof.tolerance_anti(b, a, keys, "v", 0.005).withColumn("side", F.lit("right")))
    return rounded(out, "v", places=4)


@query("""
SELECT o_orderkey, l_linenumber, round(l_extendedprice, 4) AS risk FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END, l_linenumber, l_partkey, l_extendedprice) AS k FROM orders JOIN lineitem ON o_orderkey = l_orderkey) WHERE k = 1""")
def first_match_join(spark: SparkSession, d: str) -> DataFrame:
    """One line for each order: one not returned where there is one, else the first."""
    o, x = table(spark, d, "orders").select("o_orderkey"), table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", "l_partkey")
    prefer = [F.expr("if(l_returnflag = 'N', 0, 1)"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_extendedprice")]
    best = asof.first_match(o, x, F.col("o_orderkey") == F.col("l_orderkey"), ["o_orderkey"], prefer, ["l_linenumber", "l_extendedprice"])
    return rounded(best.withColumnRenamed("l_extendedprice", "risk"), "risk", places=4)


@query("""
WITH a AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view' OR event_type = 'click'), b AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'),
x AS (SELECT user_id, day, count(*) AS n FROM a GROUP BY 1, 2), y AS (SELECT user_id, day, count(*) AS n FROM b GROUP BY 1, 2)
SELECT 'missing' AS side, user_id, day, greatest(coalesce(x.n, 0) - coalesce(y.n, 0), 0) AS n FROM x FULL JOIN y USING (user_id, day) WHERE coalesce(x.n, 0) > coalesce(y.n, 0)
UNION ALL SELECT 'extra', user_id, day, coalesce(y.n, 0) - coalesce(x.n, 0) FROM x FULL JOIN y USING (user_id, day) WHERE coalesce(y.n, 0) > coalesce(x.n, 0)""", dates=("day",))
def multiset_diff(spark: SparkSession, d: str) -> DataFrame:
    """Days that one log has more often than the other, both ways."""
    e = table(spark, d, "events").select("event_type", "user_id", F.to_date("ts").alias("day"))
    a, b = e.where("event_type IN ('view', 'click')").drop("event_type"), e.where("event_type = 'purchase'").drop("event_type")
    left, right = a.exceptAll(b).withColumn("side", F.lit("missing")), b.exceptAll(a).withColumn("side", F.lit("extra"))
    return left.unionByName(right).groupBy("side", "user_id", "day").agg(F.count("*").alias("n"))


@query("""
WITH p AS (SELECT user_id, event_type AS flag, CAST(ts AS DATE) AS day, 1 AS source FROM events WHERE event_type IN ('click', 'view') UNION ALL SELECT user_id, CASE WHEN json_extract_string(props, '$.k')::INTEGER > 50 THEN 'click' ELSE 'view' END, CAST(ts AS DATE), 2 FROM events WHERE event_type = 'purchase')
SELECT user_id, flag, day, min(source) AS source FROM p GROUP BY 1, 2, 3""", dates=("day",))
def carrier_pool(spark: SparkSession, d: str) -> DataFrame:
    """Evidence from two sources, one row each key, the better source first."""
    e = table(spark, d, "events")
    a = e.where("event_type IN ('click', 'view')").select("user_id", F.col("event_type").alias("flag"), F.to_date("ts").alias("day"), F.lit(1).alias("source"))
    b = e.where("event_type = 'purchase'").select("user_id", F.expr("if(cast(get_json_object(props, '$.k') AS int) > 50, 'click', 'view')").alias("flag"), F.to_date("ts").alias("day"), F.lit(2).alias("source"))
    return a.unionByName(b).groupBy("user_id", "flag", "day").agg(F.min("source").alias("source"))


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 3 END, value DESC, event_id) AS k FROM events)
SELECT event_id, CASE WHEN k = 1 THEN 'acted' ELSE 'overridden' END AS status FROM r""")
def precedence(spark: SparkSession, d: str) -> DataFrame:
    """Of a day's triggers the one of the best rank acts; the others are overridden."""
    from foldmark.operators.rank import precedence as first

    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    rank = F.expr("CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 3 END")
    return first(e, ["user_id", "day"], [rank, F.col("value").desc(), F.col("event_id")]).select("event_id", "status")


@query("SELECT r_regionkey, r_name FROM region EXCEPT ALL SELECT n_regionkey, CASE WHEN n_nationkey < 3 THEN r_name ELSE 'other' END FROM nation JOIN region ON n_regionkey = r_regionkey")
def stage_preserved_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of before that after does not hold: none may be missing of those a stage does not own."""
    region = table(spark, d, "region")
    after = table(spark, d, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_regionkey", F.expr("if(n_nationkey < 3, r_name, 'other')"))
    return region.select("r_regionkey", "r_name").exceptAll(after)


@query("SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderstatus = 'F' AND o_totalprice > 250000)")
def kept_subjects(spark: SparkSession, d: str) -> DataFrame:
    """Subjects left after an anti join, in their public columns."""
    from foldmark.sources.tables import public

    c = table(spark, d, "customer").join(table(spark, d, "orders").where("o_orderstatus = 'F' AND o_totalprice > 250000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")
    return public("customer", c).select("c_custkey", "c_nationkey", "c_mktsegment")


@query("SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def hidden_projection(spark: SparkSession, d: str) -> DataFrame:
    from foldmark.sources.tables import public

    return public("customer", table(spark, d, "customer"))


@query("""
WITH s AS (SELECT user_id, ts, event_id, value FROM events), c AS (SELECT user_id, day, label FROM (SELECT user_id, CAST(max(ts) AS DATE) AS day, 'end' AS label FROM events GROUP BY 1) UNION ALL SELECT user_id, CAST(min(ts) AS DATE) + 14, 'fortnight' FROM events GROUP BY user_id)
SELECT c.user_id, label, c.day, count(s.event_id) AS n_seen, round(coalesce(sum(s.value), 0), 4) AS total FROM c LEFT JOIN s ON s.user_id = c.user_id AND CAST(s.ts AS DATE) <= c.day GROUP BY 1, 2, 3""", dates=("day",))
def checkpoints(spark: SparkSession, d: str) -> DataFrame:
    """What had been seen up to each checkpoint: cumulative sums by day, asked as of the checkpoint."""
    e = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"), "value")
    ends = e.groupBy("user_id").agg(F.max("day").alias("end"), F.date_add(F.min("day"), 14).alias("fortnight"))
    c = ends.select("user_id", F.expr("stack(2, 'end', end, 'fortnight', fortnight) AS (label, day)"))
    upto = Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = e.groupBy("user_id", "day").agg(F.count("*").alias("n"), F.sum("value").alias("v"))
    days = days.select("user_id", F.col("day").alias("seen"), F.sum("n").over(upto).alias("n_seen"), F.sum("v").over(upto).alias("total"))
    found = c.join(days, (c.user_id == days.user_id) & (days.seen <= c.day)).groupBy(c.user_id, "label", "day").agg(F.max_by(F.struct("n_seen", "total"), "seen").alias("s"))
    return rounded(found.select("user_id", "label", "day", "s.n_seen", "s.total"), "total", places=4)


@query()
def position_book(spark: SparkSession, d: str) -> DataFrame:
    """A book per part, folded over its trades; each decision depends on the state left by the last."""
    x = table(spark, d, "lineitem").select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), "l_quantity")

    def step(book, row):
        book, action = machine.trade(book, row.price, row.l_quantity, stop=0.2, target=0.2, most=2)
        return book, (row.l_partkey, row.l_orderkey, row.l_linenumber, action, book.quantity)

    return machine.fold(x, "l_partkey", ["l_shipdate", "l_orderkey", "l_linenumber"], "l_partkey long, l_orderkey long, l_linenumber int, action string, quantity double", machine.Book, step)


@query("""
WITH t AS (SELECT conv_id, turn, role, text, sum(CASE WHEN role = 'user' THEN length(coalesce(text, '')) ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM conversations)
SELECT conv_id, turn, CAST(coalesce(seen, 0) AS BIGINT) AS chars_seen FROM t WHERE role = 'assistant'""")
def replay(spark: SparkSession, d: str) -> DataFrame:
    """What a system has observed before each answer, strictly in order of turns."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    said = F.sum(F.when(F.col("role") == "user", F.length(F.coalesce("text", F.lit("")))).otherwise(0)).over(w)
    return table(spark, d, "conversations").withColumn("chars_seen", F.coalesce(said, F.lit(0)).cast("long")).where("role = 'assistant'").select("conv_id", "turn", "chars_seen")
