"""Where queries are named: a function over (spark, sf_dir), and SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, dates: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Name a query. Its columns ``dates`` are given as ISO text on both sides: engines differ in how they hand out days."""

    def named(fn: Query) -> Query:
        QUERIES[fn.__name__] = (lambda spark, d: fn(spark, d).withColumns({c: F.col(c).cast("string") for c in dates})) if dates else fn
        if sql:
            casts = ", ".join(f"CAST(CAST({c} AS DATE) AS VARCHAR) AS {c}" for c in dates)
            ORACLE_SQL[fn.__name__] = f"SELECT * REPLACE ({casts}) FROM ({sql})" if dates else sql
        return fn

    return named


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Sums of doubles depend on their order in the last bits."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in columns})


DAILY_SQL = "daily AS (SELECT event_type, CAST(ts AS DATE) AS day, sum(value) AS level, count(*) AS n FROM events GROUP BY 1, 2), indexed AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day) - 1 AS t FROM daily)"


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of values of each event type and day: the series that stand in for markets."""
    from foldmark.operators.windows import day_index

    days = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum("value").alias("level"), F.count("*").alias("n"))
    return day_index(days, "event_type", "day")
