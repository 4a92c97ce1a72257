"""Windows over a dense day index, recurrences and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def day_index(days: DataFrame, key: str, day: str) -> DataFrame:
    """``t``: number of the day within its key, from 0."""
    return days.withColumn("t", F.row_number().over(Window.partitionBy(key).orderBy(day)) - 1)


def trailing_move(level: str, key: str, horizon: int) -> Column:
    """``level(t) - level(max(t - horizon, 0))``."""
    w = Window.partitionBy(key).orderBy("t")
    first = F.first(level).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.col(level) - F.coalesce(F.lag(level, horizon).over(w), first)


def forward_move(level: str, key: str, horizon: int) -> Column:
    """``level(min(t + horizon, last)) - level(t)``."""
    w = Window.partitionBy(key).orderBy("t")
    last = F.last(level).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return F.coalesce(F.lead(level, horizon).over(w), last) - F.col(level)


def horizon_sd(days: DataFrame, level: str, key: str, moves: int, horizon: int, least: float = 1e-6) -> DataFrame:
    """``sd``: sample sd of the last ``moves`` daily moves times the root of ``horizon``; with under
    5 moves that of the first ``moves`` ones, which look ahead."""
    w = Window.partitionBy(key).orderBy("t")
    days = days.withColumn("move", F.col(level) - F.lag(level).over(w))
    frame = w.rowsBetween(-(moves - 1), 0)
    whole = Window.partitionBy(key)
    early = F.stddev_samp(F.when(F.col("t") <= moves, F.col("move"))).over(whole)
    sd = F.when(F.count("move").over(frame) >= 5, F.stddev_samp("move").over(frame)).otherwise(early)
    return days.withColumn("sd", F.greatest(F.coalesce(sd, F.lit(0.0)) * float(horizon) ** 0.5, F.lit(least)))


def run_counter(rows: DataFrame, key: str, order: list[str], holds: Column) -> DataFrame:
    """``run``: how many rows in turn, this one included, the condition has held; 0 where it does not."""
    w = Window.partitionBy(key).orderBy(*order)
    rows = rows.withColumn("__holds", F.coalesce(holds, F.lit(False)))
    rows = rows.withColumn("__island", F.sum(F.when(F.col("__holds"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    inside = Window.partitionBy(key, "__island").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("run", F.sum(F.col("__holds").cast("long")).over(inside)).drop("__holds", "__island")


def longest_streak(rows: DataFrame, key: str, day: str) -> DataFrame:
    """Longest run of consecutive days of each key, and its first day (the earliest of equal ones)."""
    days = rows.select(key, day).distinct()
    island = F.date_sub(F.col(day), F.row_number().over(Window.partitionBy(key).orderBy(day)))
    runs = days.withColumn("g", island).groupBy(key, "g").agg(F.count("*").alias("days"), F.min(day).alias("first_day"))
    best = F.max_by(F.struct("days", "first_day"), F.struct("days", F.datediff(F.lit("2100-01-01").cast("date"), "first_day")))
    return runs.groupBy(key).agg(best.alias("b")).select(key, "b.days", "b.first_day")


def forward_fill(calendar: DataFrame, values: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """``filled``: the last known value on each day of ``calendar`` (key, day), and ``run``: days since it."""
    rows = calendar.join(values, [key, day], "left")
    w = Window.partitionBy(key).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.last(F.when(F.col(value).isNotNull(), F.col(day)), ignorenulls=True).over(w)
    return rows.select(key, day, F.last(value, ignorenulls=True).over(w).alias("filled"), F.datediff(day, known).cast("long").alias("run"))


def ema_fold(rows: DataFrame, key: str, day: str, value: str, half_life: float) -> DataFrame:
    """``ema`` of each key after its last event: moves by ``1 - 2^(-gap / half_life)`` on event days only.

    A recurrence has no frame; it is a fold over the key's days, which are aggregated before.
    """
    each = F.sort_array(F.collect_list(F.struct(F.col(day).alias("d"), F.col(value).alias("v"))))
    fold = f"""aggregate(slice(xs, 2, size(xs)), named_struct('d', xs[0].d, 'e', xs[0].v),
        (a, x) -> named_struct('d', x.d, 'e', a.e + (1 - power(2D, -datediff(x.d, a.d) / {half_life}D)) * (x.v - a.e)), a -> a.e)"""
    return rows.groupBy(key).agg(each.alias("xs")).select(key, F.expr(fold).alias("ema"))
