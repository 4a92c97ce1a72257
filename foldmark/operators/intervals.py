"""Days in half-open intervals, without pairs of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def covered(points: DataFrame, spans: DataFrame, by: list[str], on: str, start: str, end: str, out: str, unit: str = "MONTH") -> DataFrame:
    """``points`` with ``out``: whether ``start <= on < end`` for some row of ``spans`` of equal keys; a null end is open.

    Of the intervals that began, only the latest end matters: it is greater than the day if and only if one of them
    still runs. So the greatest end so far goes along a key's time, in slices of a ``unit``; each slice hands on its
    own greatest end, whether an interval ends at once or lasts over all of time. Null keys and days are not covered.
    """
    far = F.lit("9999-12-31").cast("timestamp")
    begun = spans.where(F.col(start).isNotNull()).dropna(subset=by)
    begun = begun.select(*by, F.col(start).cast("timestamp").alias("__t"), F.coalesce(F.col(end).cast("timestamp"), far).alias("__end"))
    begun = begun.where(F.col("__end") > F.col("__t")).groupBy(*by, "__t").agg(F.max("__end").alias("__end"))
    rows = points.withColumns({"__t": F.col(on).cast("timestamp"), "__point": F.lit(True)}).unionByName(begun, allowMissingColumns=True)
    rows = rows.withColumn("__slice", F.date_trunc(unit, F.col("__t")))
    # equal times are one place: an interval covers its own first day
    within = Window.partitionBy(*by, "__slice").orderBy("__t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__so_far", F.max("__end").over(within)).where("__point")
    slices = begun.withColumn("__slice", F.date_trunc(unit, F.col("__t"))).groupBy(*by, "__slice").agg(F.max("__end").alias("__most"))
    asked = points.select(*by, F.date_trunc(unit, F.col(on).cast("timestamp")).alias("__slice")).distinct()
    slices = slices.unionByName(asked, allowMissingColumns=True).groupBy(*by, "__slice").agg(F.max("__most").alias("__most"))
    before = F.max("__most").over(Window.partitionBy(*by).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1))
    carry = slices.select(*by, "__slice", before.alias("__before"))
    last = F.greatest("__so_far", "__before")
    return rows.join(carry, [*by, "__slice"], "left").select(*points.columns, F.coalesce(last > F.col("__t"), F.lit(False)).alias(out))


def rows_until(rows: DataFrame, marks: DataFrame, by: str, on: str, mark: str, last: int | None = None) -> DataFrame:
    """For each of ``marks`` (by, mark) the ``rows`` of its key on or before it, numbered from the latest, at most ``last`` of them."""
    found = marks.select(by, mark).join(rows, by).where(F.col(on) <= F.col(mark))
    place = F.row_number().over(Window.partitionBy(by, mark).orderBy(F.col(on).desc(), *(F.col(c) for c in rows.columns if c not in (by, on))))
    found = found.withColumn("back", place)
    return found.where(F.col("back") <= last) if last else found
