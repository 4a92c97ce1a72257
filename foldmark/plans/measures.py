"""Leaks of names, pooled tests, all estimates in one scan, days in dormant windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.operators import estimators, intervals, patterns, pooled
from foldmark.operators.estimators import Estimator
from foldmark.plans.registry import query, rounded, table

# names: customers, which count with their underscore alone, and kinds of parts, which count in plain words, too
_SAID_SQL = "'Take the ' || CASE WHEN o_orderkey % 4 = 0 THEN replace(p_name, ' ', '_') WHEN o_orderkey % 4 = 1 THEN upper(p_name) ELSE p_name || 's' END || ', not Customer_' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') || CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE '' END || '.'"


@query(f"""
WITH names AS (SELECT DISTINCT replace(p_name, ' ', '_') AS name, p_name AS form FROM part UNION SELECT DISTINCT replace(p_name, ' ', '_'), replace(p_name, ' ', '_') FROM part UNION SELECT 'customer_' || lpad(CAST(c_custkey AS VARCHAR), 6, '0'), 'customer_' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') FROM customer),
t AS (SELECT o_custkey, o_orderkey, {_SAID_SQL} AS text FROM orders JOIN part ON p_partkey = o_orderkey % (SELECT count(*) FROM part) WHERE o_orderstatus <> 'P'),
k AS (SELECT o_custkey, lower(text) AS text, regexp_extract_all(lower(text), '[a-z0-9_]+') AS w FROM t),
f AS (SELECT o_custkey, text, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS form FROM k),
h AS (SELECT DISTINCT o_custkey, name FROM f JOIN names USING (form) WHERE contains(text, form))
SELECT o_custkey, string_agg('names a parameter: ' || name, ';' ORDER BY name) AS reasons FROM h GROUP BY 1""")
def name_leaks(spark: SparkSession, d: str) -> DataFrame:
    """What each customer's turns name of thousands of names, as whole words, sorted and once."""
    part, orders = table(spark, d, "part"), table(spark, d, "orders")
    names = part.select(F.replace("p_name", F.lit(" "), F.lit("_")).alias("name"), F.lit("bias").alias("kind")).distinct()
    names = names.unionByName(table(spark, d, "customer").select(F.concat(F.lit("customer_"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("name"), F.lit("preference").alias("kind")))
    named = F.expr("CASE WHEN o_orderkey % 4 = 0 THEN replace(p_name, ' ', '_') WHEN o_orderkey % 4 = 1 THEN upper(p_name) ELSE concat(p_name, 's') END")
    said = F.concat(F.lit("Take the "), named, F.lit(", not Customer_"), F.lpad(F.col("o_custkey").cast("string"), 6, "0"), F.expr("if(o_orderkey % 3 = 0, 'x', '')"), F.lit("."))
    turns = orders.join(part, F.col("p_partkey") == F.col("o_orderkey") % part.count()).select("o_custkey", F.when(F.col("o_orderstatus") != "P", "user").otherwise("assistant").alias("role"), said.alias("text"))
    return patterns.leaks(turns, names, ["o_custkey"], "user").select("o_custkey", F.array_join("reasons", ";").alias("reasons"))


_CHANCE = "1.0 / (2 + c_nationkey % 3)"


@query(f"""
WITH t AS (SELECT c_mktsegment AS cell, {_CHANCE} AS chance, c_acctbal > 4000 AS hit, c_custkey FROM customer), s AS (SELECT * FROM t UNION ALL SELECT 'all', chance, hit, c_custkey FROM t UNION ALL SELECT 'few', chance, hit, c_custkey FROM t WHERE c_custkey < 2),
a AS (SELECT cell, count(*) AS n, count(CASE WHEN hit THEN 1 END) AS hits, avg(chance) AS chance, sum(ln(chance)) AS log_all, list(chance::DOUBLE ORDER BY c_custkey) AS ps FROM s GROUP BY 1),
x AS (SELECT *, list_reduce(list_prepend([1.0::DOUBLE], list_transform(ps, lambda p: [p])), lambda d, q: list_transform(range(1, len(d) + 2), lambda i: coalesce(d[i], 0) * (1 - q[1]) + CASE WHEN i > 1 THEN coalesce(d[i - 1], 0) * q[1] ELSE 0 END)) AS dist FROM a),
p AS (SELECT *, n >= 5 AND exp(log_all) < 0.05 AS enough, least(1.0, list_sum(dist[hits + 1:])) AS tail FROM x)
SELECT cell, n, hits AS n_positive, round(hits / n, 6) AS rate, round(chance, 6) AS chance, CASE WHEN enough THEN round(tail, 6) END AS p, CASE WHEN NOT enough THEN 'insufficient' WHEN tail < 0.05 THEN 'pass' ELSE 'fail' END AS verdict FROM p""")
def preference_cells(spark: SparkSession, d: str) -> DataFrame:
    """Hits of tries with one chance in two to four, by segment, over all, and for the first few alone."""
    c = table(spark, d, "customer").select("c_mktsegment", "c_custkey", F.expr("1D / (2 + c_nationkey % 3)").alias("chance"), (F.col("c_acctbal") > 4000).alias("hit"))
    cell = F.explode(F.array_compact(F.array(F.col("c_mktsegment"), F.lit("all"), F.when(F.col("c_custkey") < 2, F.lit("few")))))
    return rounded(pooled.pooled_cells(c.select(cell.alias("cell"), "chance", "hit"), ["cell"], 0.05, 5), "rate", "chance", "p")


# position days are line items: at a loss where the price is under the part's, what was done by the flag, a trigger by the line
_DAYS_SQL = """SELECT l_suppkey, CASE WHEN l_extendedprice < p_retailprice * l_quantity THEN 'loss' ELSE 'gain' END AS pnl_state, l_tax > 0.06 AS trigger_pending, CASE l_returnflag WHEN 'R' THEN 'add' WHEN 'A' THEN 'cut' ELSE 'hold' END AS action, CAST(l_shipdate AS DATE) AS day,
  l_suppkey % 2 = 0 AS no_add, l_linenumber - 1 AS triggers_fired, l_linestatus, l_quantity, l_discount, l_tax, l_extendedprice, max(CAST(l_shipdate AS DATE)) OVER (PARTITION BY l_suppkey) AS last_day FROM lineitem JOIN part ON l_partkey = p_partkey"""
_SPLITS = {"all": "true", "up": "day < date'1997-01-01'", "down": "day >= date'1997-01-01'"}
_OPEN = "pnl_state = 'loss' AND NOT trigger_pending AND action <> 'roll' AND day <> last_day"
_SHARES = {
    "disposition": ("action <> 'hold'", "pnl_state = 'gain'"), "exit_deficiency": ("l_linestatus = 'F'", "l_quantity < 10"), "herding": ("l_discount <> 0.05", "(l_discount > 0.05) = (l_tax > 0.04)"),
    "overconfidence": ("l_extendedprice IS NOT NULL", "l_extendedprice BETWEEN 1000 * l_quantity AND 2000 * l_quantity"), "anchoring": ("l_quantity > 60", "true"),
}


def _estimates_sql() -> str:
    shares = {"loss_aversion": (f"{_OPEN} AND NOT (no_add AND triggers_fired = 0)", "action = 'add'")} | _SHARES
    one = "SELECT l_suppkey, split, '{p}' AS param, count(CASE WHEN ({o}) AND ({h}) THEN 1 END) / nullif(count(CASE WHEN {o} THEN 1 END), 0) AS value, count(CASE WHEN {o} THEN 1 END) AS n, count(CASE WHEN {c} THEN 1 END) AS n_counted FROM s GROUP BY 1, 2"
    parts = [one.format(p=p, o=o, h=h, c=_OPEN if p == "loss_aversion" else o) for p, (o, h) in shares.items()]
    parts.append("SELECT l_suppkey, split, 'conviction', corr(l_quantity, l_extendedprice), count(*), count(*) FROM s GROUP BY 1, 2")
    fan = " UNION ALL ".join(f"SELECT *, '{k}' AS split FROM d WHERE {v}" for k, v in _SPLITS.items())
    return f"WITH d AS ({_DAYS_SQL}), s AS ({fan}), e AS ({' UNION ALL '.join(parts)})"


REGISTRY = [
    estimators.loss_aversion(), *(Estimator(p, o, h, blocking=p != "overconfidence") for p, (o, h) in _SHARES.items()),
    Estimator("conviction", "true", value="corr(l_quantity, l_extendedprice)"),
]


def _estimates(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    x = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    action = F.when(F.col("l_returnflag") == "R", "add").when(F.col("l_returnflag") == "A", "cut").otherwise("hold")
    days = x.select(
        "l_suppkey", F.expr("if(l_extendedprice < p_retailprice * l_quantity, 'loss', 'gain')").alias("pnl_state"), F.expr("l_tax > 0.06").alias("trigger_pending"), action.alias("action"), F.to_date("l_shipdate").alias("day"),
        F.expr("l_suppkey % 2 = 0").alias("no_add"), F.expr("l_linenumber - 1").alias("triggers_fired"), "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_extendedprice", F.max(F.to_date("l_shipdate")).over(Window.partitionBy("l_suppkey")).alias("last_day"),
    )
    return estimators.estimate_all(days, ["l_suppkey"], REGISTRY, _SPLITS)


@query(_estimates_sql() + " SELECT l_suppkey, split, param, CASE WHEN isnan(value) THEN NULL ELSE round(value, 6) END AS value, n, n_counted FROM e")
def all_estimates(spark: SparkSession, d: str) -> DataFrame:
    """Seven parameters of every subject over three splits, one aggregate."""
    return rounded(_estimates(spark, d), "value")


_CELLS_SQL = """, m AS (SELECT param, value, s_acctbal > 4000 AS active FROM e JOIN supplier ON s_suppkey = l_suppkey WHERE split = 'all' AND param <> 'anchoring'),
c AS (SELECT param, count(CASE WHEN NOT active THEN value END) AS nn, count(CASE WHEN active THEN value END) AS na, avg(CASE WHEN NOT active THEN value END) AS mn, avg(CASE WHEN active THEN value END) AS ma,
  stddev_samp(CASE WHEN NOT active THEN value END) AS sn, stddev_samp(CASE WHEN active THEN value END) AS sa FROM m GROUP BY 1),
v AS (SELECT param, CASE WHEN nn < 5 OR na < 5 THEN 'insufficient' WHEN coalesce((ma - mn) / nullif(sqrt(sn * sn / nn + sa * sa / na), 0) >= 3, false) THEN 'pass' ELSE 'fail' END AS verdict FROM c)
SELECT 'all/' || param || CASE WHEN verdict IS NULL THEN ': missing' ELSE '' END AS failure FROM (SELECT unnest(['loss_aversion', 'disposition', 'exit_deficiency', 'herding', 'anchoring', 'conviction']) AS param) LEFT JOIN v USING (param) WHERE verdict IS NULL OR verdict <> 'pass'"""


@query(_estimates_sql() + _CELLS_SQL)
def estimate_failures(spark: SparkSession, d: str) -> DataFrame:
    """Blocking parameters whose cell over all subjects does not pass, and those that have none: no subject has the trait anchoring here."""
    subjects = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), (F.col("s_acctbal") > 4000).alias("active"), F.col("s_nationkey").alias("group"))
    params = F.explode(F.array(*(F.lit(e.param) for e in REGISTRY if e.param != "anchoring"))).alias("param")
    found = estimators.judged(_estimates(spark, d).where("split = 'all'"), subjects.select("*", params), "l_suppkey", "group")
    return estimators.blocking_failures(found, REGISTRY)


@query("""
WITH s AS (SELECT user_id, CAST(ts AS DATE) AS first, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(ts AS DATE) + CAST(event_id % 4 AS INTEGER) END AS last FROM events WHERE event_type = 'error' AND event_id % 3 = 0)
SELECT event_id, user_id, EXISTS (SELECT 1 FROM s WHERE s.user_id = e.user_id AND CAST(e.ts AS DATE) >= s.first AND CAST(e.ts AS DATE) < coalesce(s.last, DATE '9999-12-31')) AS dormant FROM events e WHERE event_type = 'purchase'""")
def dormant_days(spark: SparkSession, d: str) -> DataFrame:
    """Whether a subject's trait sleeps on a day: from its start on, before its end, for ever without one."""
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    spans = e.where("event_type = 'error' AND event_id % 3 = 0").select("user_id", F.col("day").alias("first"), F.expr("if(event_id % 5 = 0, NULL, date_add(day, cast(event_id % 4 AS int)))").alias("last"))
    found = intervals.covered(e.where("event_type = 'purchase'").select("event_id", "user_id", "day"), spans, ["user_id"], "day", "first", "last", "dormant", unit="WEEK")
    return found.select("event_id", "user_id", "dormant")


@query("""
WITH m AS (SELECT user_id, CAST(unnest([DATE '2024-01-08', DATE '2024-01-22']) AS DATE) AS mark FROM (SELECT DISTINCT user_id FROM events)), s AS (SELECT user_id, event_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'click'),
x AS (SELECT m.user_id, m.mark, s.day, s.event_id, row_number() OVER (PARTITION BY m.user_id, m.mark ORDER BY s.day DESC, s.event_id) AS back FROM m JOIN s ON s.user_id = m.user_id AND s.day <= m.mark)
SELECT user_id, mark, day, event_id, CAST(back AS INTEGER) AS back FROM x WHERE back <= 3""", dates=("mark", "day"))
def sessions_until(spark: SparkSession, d: str) -> DataFrame:
    """The last three sessions of each subject up to each checkpoint."""
    e = table(spark, d, "events")
    marks = e.select("user_id").distinct().select("user_id", F.explode(F.expr("array(date'2024-01-08', date'2024-01-22')")).alias("mark"))
    return intervals.rows_until(e.where("event_type = 'click'").select("user_id", F.to_date("ts").alias("day"), "event_id"), marks, "user_id", "day", "mark", 3)
