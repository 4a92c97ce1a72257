"""As-of, interval and tolerance joins.

A key may hold a third of all rows, so an as-of join never sorts a whole key in one task: keys are cut
into slices of time, each slice is matched on its own, and what a slice carries over comes from a
table with one row per key and slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_backward(left: DataFrame, right: DataFrame, by: str, on: str, value: str, out: str, unit: str = "DAY", tie: str | None = None) -> DataFrame:
    """``left`` with ``out``: ``value`` of the last row of ``right`` with equal ``by`` on or before ``on``, in slices of a ``unit`` of time.

    Of right rows at one time the one with the greatest ``tie`` (else ``value``) counts; null keys match nothing.
    """
    names = left.columns
    order = F.col(tie or value)
    said = right.where(F.col(by).isNotNull() & F.col(on).isNotNull()).groupBy(by, on).agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(order, F.col(value))).alias("__said"))
    rows = left.select(*names, F.lit(None).cast(said.schema["__said"].dataType).alias("__said"), F.lit(1).alias("__side")).unionByName(
        said.select(by, on, "__said", F.lit(0).alias("__side")), allowMissingColumns=True
    )
    rows = rows.withColumn("__slice", F.date_trunc(unit, F.col(on)))
    within = Window.partitionBy(by, "__slice").orderBy(on, "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__seen", F.last("__said", ignorenulls=True).over(within)).where("__side = 1")
    last = said.groupBy(by, F.date_trunc(unit, F.col(on)).alias("__slice")).agg(F.max_by("__said", on).alias("__last"))
    # slices that only the left side has are asked for, too
    slices = last.unionByName(left.select(by, F.date_trunc(unit, F.col(on)).alias("__slice")).distinct(), allowMissingColumns=True).groupBy(by, "__slice").agg(F.first("__last", ignorenulls=True).alias("__last"))
    carry = Window.partitionBy(by).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    before = slices.withColumn("__carry", F.last("__last", ignorenulls=True).over(carry)).select(by, "__slice", "__carry")
    return rows.join(before, [by, "__slice"], "left").select(*names, F.coalesce("__seen", "__carry")["v"].alias(out))


def interval_join(left: DataFrame, spans: list[tuple[str, str, str]], on: str, out: str, default: str) -> DataFrame:
    """``out``: name of the span (name, first day, last day) that holds ``on``; spans are few and given."""
    found = F.lit(None).cast("string")
    for name, first, last in spans:
        found = F.when((F.col(on) >= F.lit(first).cast("date")) & (F.col(on) <= F.lit(last).cast("date")), F.lit(name)).otherwise(found)
    return left.withColumn(out, F.coalesce(found, F.lit(default)))


def tolerance_anti(left: DataFrame, right: DataFrame, by: list[str], value: str, relative: float, least: float = 1e-9) -> DataFrame:
    """Rows of ``left`` without a row of ``right`` of equal keys whose value is within ``relative`` of theirs, or within ``least``."""
    other = right.select(*(F.col(c).alias(f"r_{c}") for c in by), F.col(value).alias("r_value"))
    near = F.abs(F.col(value) - F.col("r_value")) <= F.greatest(relative * F.abs(F.col("r_value")), F.lit(least))
    same: Column = near
    for c in by:
        same = same & (F.col(c) == F.col(f"r_{c}"))
    return left.join(other, same, "left_anti")


def first_match(left: DataFrame, right: DataFrame, on: Column, keys: list[str], prefer: list[Column], take: list[str]) -> DataFrame:
    """``keys`` and the columns ``take`` of the row of the join that comes first in the order ``prefer``; an aggregate, no sort."""
    best = F.min_by(F.struct(*take), F.struct(*prefer))
    return left.join(right, on).groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


def paired_with_next(rows: DataFrame, by: str, on: str, closes: Column, out: str, unit: str = "DAY") -> DataFrame:
    """``out``: for each row the first strictly later ``on`` at which ``closes`` holds, in slices of a ``unit`` of time; null keys have none."""
    rows = rows.withColumns({"__t": F.unix_micros(F.col(on).cast("timestamp")), "__slice": F.date_trunc(unit, F.col(on)), "__close": F.when(closes, F.col(on))})
    later = Window.partitionBy(by, "__slice").orderBy("__t").rangeBetween(1, Window.unboundedFollowing)
    first = rows.groupBy(by, "__slice").agg(F.min("__close").alias("__first"))
    after = Window.partitionBy(by).orderBy("__slice").rowsBetween(1, Window.unboundedFollowing)
    carry = first.select(by, "__slice", F.min("__first").over(after).alias("__carry"))
    found = rows.withColumn("__near", F.min("__close").over(later)).join(carry, [by, "__slice"], "left")
    return found.withColumn(out, F.coalesce("__near", "__carry")).drop("__t", "__slice", "__close", "__near", "__carry")


#: Numbers of a slice differ by at most this part of their size; slices are sorted on their own.
SLICE_WIDTH = 1 / 1024


def number_slice(x: Column, width: float = SLICE_WIDTH) -> Column:
    """Number of the slice of ``x`` on a logarithmic scale, in the order of the numbers; 0 is a slice of its own."""
    size = F.floor(F.log(F.abs(x)) / width) + F.lit(1 << 40)
    return F.when(x == 0, F.lit(0).cast("long")).when(x > 0, size).otherwise(-size)


def neighbours(left: DataFrame, right: DataFrame, by: list[str], value: str, width: float = SLICE_WIDTH) -> DataFrame:
    """``by, value, below, above``: for each different number of ``left`` the greatest number of ``right`` of equal keys
    that is at most it, and the least one that is at least it. Null keys and numbers have none and are left out.

    No pairs are made: equal numbers are one row, each slice of a key's numbers is sorted on its own, and what reaches
    over from other slices comes from a table with one row per key and slice.
    """
    known = lambda df: df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).dropna(subset=by).select(*by, F.col(value).cast("double").alias(value)).distinct()
    points, refs = known(left), known(right)
    rows = points.withColumn("__ref", F.lit(None).cast("double")).unionByName(refs.withColumn("__ref", F.col(value)))
    rows = rows.withColumn("__slice", number_slice(F.col(value), width))
    within = Window.partitionBy(*by, "__slice").orderBy(value)
    below = F.last("__ref", ignorenulls=True).over(within.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    above = F.first("__ref", ignorenulls=True).over(within.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumns({"__below": below, "__above": above}).where(F.col("__ref").isNull())
    slices = points.unionByName(refs.withColumn("__ref", F.col(value)), allowMissingColumns=True).groupBy(*by, number_slice(F.col(value), width).alias("__slice"))
    slices = slices.agg(F.min("__ref").alias("__least"), F.max("__ref").alias("__most"))
    order = Window.partitionBy(*by).orderBy("__slice")
    lower = F.last("__most", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    upper = F.first("__least", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    carry = slices.select(*by, "__slice", lower.alias("__lower"), upper.alias("__upper"))
    found = rows.join(carry, [*by, "__slice"])
    return found.select(*by, value, F.coalesce("__below", "__lower").alias("below"), F.coalesce("__above", "__upper").alias("above"))


def agrees(value: Column, reference: Column, relative: float, least: float = 1e-9) -> Column:
    """Whether ``value`` is within ``relative`` of the reference's size, at least that of ``least``; null is no."""
    return F.coalesce(F.abs(value - reference) <= relative * F.greatest(F.abs(reference), F.lit(least)), F.lit(False))


def confirmed_by_any(left: DataFrame, right: DataFrame, by: list[str], value: str, relative: float, out: str = "confirmed", least: float = 1e-9) -> DataFrame:
    """All rows of ``left`` with ``out``: whether some row of ``right`` of equal keys has a number that :func:`agrees`.

    What a reference accepts reaches the further the greater it is (``relative`` is at most 1), so only the two
    next to a number, below and above, can be the ones that accept it.
    """
    if not 0 <= relative <= 1:
        raise ValueError("the tolerance is a share")
    near = neighbours(left, right, by, value)
    number = F.col(value)
    near = near.select(*by, value, (agrees(number, F.col("below"), relative, least) | agrees(number, F.col("above"), relative, least)).alias("__yes")).where("__yes")
    near = near.select(*(F.col(c).alias(f"__{c}") for c in by), F.col(value).alias("__number"), "__yes")
    same = F.col(value).cast("double") == F.col("__number")
    for c in by:
        same = same & (F.col(c) == F.col(f"__{c}"))
    return left.join(near, same, "left").select(*left.columns, F.coalesce("__yes", F.lit(False)).alias(out))


def confirmed_by_market(mentions: DataFrame, quotes: DataFrame, by: list[str], scales: dict[str, float], relative: float, least: float = 1e-9) -> DataFrame:
    """``mentions`` (by, day, unit, value) with ``reference`` and ``confirmed``: against the last of ``quotes`` (by, day,
    unit, value) on or before the day. Both are brought to one unit by ``scales``; an unknown unit, no quote, or a last quote
    without a value confirms nothing."""
    keys = F.struct(*by)
    table = F.create_map(*(F.lit(x) for pair in scales.items() for x in pair))
    scaled = lambda df: df.withColumn("__by", keys).withColumn("__value", F.col("value") * F.element_at(table, F.col("unit")))
    names = [*mentions.columns, "__by", "__value"]
    found = asof_backward(scaled(mentions).select(*names), scaled(quotes), "__by", "day", "__value", "reference", unit="MONTH")
    return found.select(*mentions.columns, "reference", agrees(F.col("__value"), F.col("reference"), relative, least).alias("confirmed"))
