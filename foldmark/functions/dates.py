"""Calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def third_friday(day: Column) -> Column:
    """The third Friday of the month of ``day``."""
    return F.date_add(F.next_day(F.date_sub(F.trunc(day, "MM"), 1), "Fri"), 14)


def weekdays(spark: SparkSession, first: str, last: str) -> DataFrame:
    """``t, day``: Mondays to Fridays from ``first`` to ``last`` in turn."""
    days = spark.range(1).select(F.explode(F.expr(f"sequence(date'{first}', date'{last}')")).alias("day")).where("weekday(day) < 5")
    # five weekdays a week: the number follows from the date, without ordering the days
    start = F.lit(first).cast("date")
    monday = F.date_sub(F.date_add(start, 0), F.expr(f"weekday(date'{first}')"))
    before = F.least(F.expr(f"weekday(date'{first}')"), F.lit(5))
    return days.select((F.floor(F.datediff("day", monday) / 7) * 5 + F.expr("weekday(day)") - before).cast("long").alias("t"), "day")


def week_of(day: Column, first: str) -> Column:
    """Weeks since ``first``, from 1."""
    return (F.floor(F.datediff(day, F.lit(first).cast("date")) / 7) + 1).cast("long")
