"""Stages under their contract, over tables that a manifest commits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.plans.registry import query, rounded, table
from foldmark.plans.storage import _place
from foldmark.sources.tables import Table
from foldmark.sources.versions import Append, Stage, StageError, Store, ordered_read, ordered_write, run_stage

ORDERS = Table("orders", "o_orderkey long, o_custkey long, o_totalprice double", ("o_orderkey",), (), {"a price": "o_totalprice IS NOT NULL"})
TOTALS = Table("totals", "o_custkey long, n long, total double, origin string", ("o_custkey", "origin"))


def _outcome(run) -> str:
    try:
        run()
        return "done"
    except StageError as e:
        return str(e).split(":")[0].split("'")[-1].strip()


@query("""
WITH t AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1), l AS (SELECT o_custkey, count(*) AS n, sum(l_extendedprice) AS total FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1),
a AS (SELECT *, 'orders' AS origin FROM t UNION ALL SELECT *, 'lines' FROM l)
SELECT o_custkey, origin, n, round(total, 2) AS total, '1 misses tables, 2 done, 3 would overwrite tables, 4 done, 5 altered rows of others in' AS log, CAST(3 AS BIGINT) AS version FROM a""")
def stage_runs(spark: SparkSession, d: str) -> DataFrame:
    """Totals by one stage, refused before its input is there and over its own output, then forced; a second stage
    appends; a third one that drops rows of others is refused, and the version before it is read."""
    store = Store(spark, _place(spark, "stages"), kinds={"totals": "json"})
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice")

    def sums(rows: DataFrame, price: str, origin: str) -> DataFrame:
        return rows.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum(price).alias("total")).withColumn("origin", F.lit(origin))

    def first(s: Store) -> None:
        s.write(sums(s.read(ORDERS), "o_totalprice", "orders"), TOTALS)

    def second(s: Store) -> None:
        own = sums(s.read(ORDERS).join(lines, "o_orderkey"), "l_extendedprice", "lines")
        s.write(s.read(TOTALS).where("origin <> 'lines'").unionByName(own), TOTALS)

    def third(s: Store) -> None:
        s.write(s.read(TOTALS).where("origin = 'lines'"), TOTALS)

    totals = Stage("totals", first, reads=(ORDERS,), writes=(TOTALS,))
    log = [f"1 {_outcome(lambda: run_stage(totals, store))}"]
    store.write(table(spark, d, "orders").select(*ORDERS.struct.names), ORDERS)
    log.append(f"2 {_outcome(lambda: run_stage(totals, store))}")
    log.append(f"3 {_outcome(lambda: run_stage(totals, store))}")
    run_stage(totals, store, force=True)
    more = Stage("lines", second, reads=(ORDERS,), appends=(Append(TOTALS, F.col("origin") == "lines"),))
    log.append(f"4 {_outcome(lambda: run_stage(more, store))}")
    version = store.written["totals"]
    bad = Stage("bad", third, appends=(Append(TOTALS, F.col("origin") == "lines"),))
    log.append(f"5 {_outcome(lambda: run_stage(bad, store))}")
    out = store.read(TOTALS, version).select("o_custkey", "origin", "n", "total")
    return rounded(out, "total", places=2).withColumns({"log": F.lit(", ".join(log)), "version": F.lit(version).cast("long")})


@query("SELECT c_mktsegment, c_custkey, row_number() OVER (ORDER BY c_mktsegment NULLS FIRST, c_custkey NULLS FIRST) AS place FROM customer")
def canonical_order(spark: SparkSession, d: str) -> DataFrame:
    """Customers written in a total order from shuffled rows and read back with their places."""
    rows = table(spark, d, "customer").select("c_mktsegment", "c_custkey").repartition(7, F.xxhash64("c_custkey"))
    return ordered_read(spark, ordered_write(rows, ["c_mktsegment", "c_custkey"], _place(spark, "ordered")), "place")
