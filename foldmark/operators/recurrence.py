"""Linear recurrences as affine maps that compose, so that no task folds a whole key.

``e(i) = a(i) * e(i - 1) + b(i)`` is a map of what was before. A key's rows are cut into slices of time; within a
slice the maps are composed by running sums, and each slice is itself one map. These, one row for each key and slice,
are composed in turn and carried over to the rows of the next slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A running sum within a slice starts anew where what came before has faded by exp(-FADE).
FADE = 300.0


def with_previous(rows: DataFrame, by: list[str], on: str, slice_: str, out: str) -> DataFrame:
    """``out``: the ``on`` of the row before, in whatever slice it lies; null for the first row of a key."""
    ends = rows.groupBy(*by, slice_).agg(F.max(on).alias("__end"))
    before = F.max("__end").over(Window.partitionBy(*by).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.withColumn("__before", before).drop("__end")
    return rows.withColumn(out, F.lag(on).over(Window.partitionBy(*by, slice_).orderBy(on))).join(ends, [*by, slice_]).withColumn(out, F.coalesce(out, "__before")).drop("__before")


def with_running_sum(rows: DataFrame, by: list[str], on: str, slice_: str, value: Column, out: str) -> DataFrame:
    """``out``: sum of ``value`` over the rows of a key up to this one."""
    rows = rows.withColumn("__v", value)
    totals = rows.groupBy(*by, slice_).agg(F.sum("__v").alias("__t"))
    before = F.coalesce(F.sum("__t").over(Window.partitionBy(*by).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.withColumn("__before", before).drop("__t")
    within = F.sum("__v").over(Window.partitionBy(*by, slice_).orderBy(on).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("__within", within).join(totals, [*by, slice_]).withColumn(out, F.col("__within") + F.col("__before")).drop("__v", "__within", "__before")


def composed(rows: DataFrame, by: list[str], on: str, slice_: str, a: Column, b: Column) -> DataFrame:
    """``rows`` with ``factor`` and ``offset``: after each row the recurrence is ``factor * start + offset``.

    ``a`` is from 0 to 1, ``on`` differs within a key, keys are not null, ``slice_`` is in the order of ``on``.
    """
    rows = rows.withColumns({"__a": a.cast("double"), "__b": b.cast("double")})
    within = Window.partitionBy(*by, slice_).orderBy(on).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__faded", F.sum(-F.log(F.greatest("__a", F.lit(1e-300)))).over(within)).withColumn("__piece", F.floor(F.col("__faded") / FADE))
    piece = Window.partitionBy(*by, slice_, "__piece").orderBy(on).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"__local": F.col("__faded") - F.first("__faded").over(piece), "__first": F.first("__a").over(piece)})
    rows = rows.withColumn("__sum", F.sum(F.col("__b") * F.exp("__local")).over(piece))
    maps = rows.groupBy(*by, slice_, "__piece").agg(F.max_by(F.struct("__local", "__sum", "__first"), on).alias("m"))
    maps = maps.select(*by, slice_, "__piece", (F.col("m.__first") * F.exp(-F.col("m.__local"))).alias("a"), (F.col("m.__sum") * F.exp(-F.col("m.__local"))).alias("b"))
    key = maps.schema.fields[: len(by) + 2]
    schema = T.StructType([*key, T.StructField("__factor", T.DoubleType()), T.StructField("__offset", T.DoubleType())])

    def carry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Before each slice the composition of all maps of slices before it. Rows come in order, key by key."""
        last, p, q = None, 1.0, 0.0
        for own in batches:
            factor, offset = np.ones(len(own)), np.zeros(len(own))
            keys = zip(*(own[c] for c in by), strict=True)
            for k, (key, x, y) in enumerate(zip(keys, own["a"].to_numpy(), own["b"].to_numpy(), strict=True)):
                if key != last:
                    last, p, q = key, 1.0, 0.0
                factor[k], offset[k] = p, q
                p, q = x * p, x * q + y
            yield own.drop(columns=["a", "b"]).assign(__factor=factor, __offset=offset)

    # one row for each slice of a key; keys stream by, as a function called for each would cost more than its few rows
    before = maps.repartition(*by).sortWithinPartitions(*by, slice_, "__piece").mapInPandas(carry, schema)
    fade = F.exp(-F.col("__local"))
    found = rows.join(before, [*by, slice_, "__piece"]).withColumns(
        {"factor": fade * F.col("__first") * F.col("__factor"), "offset": fade * (F.col("__first") * F.col("__offset") + F.col("__sum"))}
    )
    return found.drop("__a", "__b", "__faded", "__piece", "__local", "__first", "__sum", "__factor", "__offset")


def eased(rows: DataFrame, by: list[str], on: str, slice_: str, target: Column, half_life: float, start: float, first: float, out: str) -> DataFrame:
    """``out``: moves on each row by ``1 - 2^(-gap / half_life)`` towards ``target``; the gap is that of the number ``on``
    to the row before, for the first one to ``first``."""
    rows = with_previous(rows, by, on, slice_, "__last")
    stay = F.pow(F.lit(2.0), -(F.col(on) - F.coalesce("__last", F.lit(first))) / half_life)
    found = composed(rows, by, on, slice_, stay, (1 - stay) * target)
    return found.withColumn(out, F.col("factor") * start + F.col("offset")).drop("factor", "offset", "__last")


def event_ema(rows: DataFrame, key: str, day: str, value: str, half_life: float, unit: str = "MONTH") -> DataFrame:
    """``ema`` on each day of a key: the first value, then eased by the days that went by since the one before."""
    rows = rows.where(F.col(key).isNotNull()).withColumns({"__t": F.unix_date(F.to_date(day)), "__slice": F.date_trunc(unit, F.col(day))})
    rows = with_previous(rows, [key], "__t", "__slice", "__last")
    stay = F.when(F.col("__last").isNull(), 0.0).otherwise(F.pow(F.lit(2.0), -(F.col("__t") - F.col("__last")) / half_life))
    found = composed(rows, [key], "__t", "__slice", stay, (1 - stay) * F.col(value))
    return found.withColumn("ema", F.col("offset")).drop("factor", "offset", "__last", "__t", "__slice")


def street_scores(rows: DataFrame, key: str, t: str, trend: str, updates: str, flips: str, half_life: float, threshold: float, width: int = 64) -> DataFrame:
    """``rows`` with ``street_score``: an average that eases to ``trend`` on updates, by the days since the last
    update or flip, and is thrown to the other side, to twice the threshold, on flips; other days keep it.

    A flip depends on the sign of what was before, so the rows between two flips are one affine map of a start of
    either sign, and each such map sends signs to signs: to the same one whatever the start, or to the other one. These
    compose, too: the last constant one counts, and how many others came after it.
    """
    rows = rows.withColumn("__slice", F.floor(F.col(t) / width))
    acts = rows.where(F.col(updates) | F.col(flips)).select(key, t, "__slice", F.col(trend).alias("__trend"), F.col(flips).alias("__flip"))
    acts = with_previous(acts, [key], t, "__slice", "__last")
    acts = with_running_sum(acts, [key], t, "__slice", F.col("__flip").cast("long"), "__segment")
    by = [key, "__segment"]
    stay = F.when(F.col("__flip"), 1.0).otherwise(F.pow(F.lit(2.0), -(F.col(t) - F.coalesce("__last", F.lit(0))) / half_life))
    acts = composed(acts, by, t, "__slice", stay, F.when(F.col("__flip"), 0.0).otherwise((1 - stay) * F.col("__trend")))
    ends = acts.groupBy(*by).agg(F.max_by(F.struct("factor", "offset"), t).alias("e"))
    high = 2.0 * threshold
    sign = lambda start: F.when(F.col("e.factor") * start + F.col("e.offset") >= 0, -1).otherwise(1)  # noqa: E731  after the flip that ends it
    up, down = sign(F.when(F.col("__segment") == 0, 0.0).otherwise(high)), sign(F.when(F.col("__segment") == 0, 0.0).otherwise(-high))
    ends = ends.select(*by, F.when(up == down, up).alias("fixed"))
    order = Window.partitionBy(key).orderBy("__segment")
    turns = F.sum(F.when(F.col("fixed").isNull(), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = ends.withColumn("turns", turns).withColumn("told", F.when(F.col("fixed").isNotNull(), F.struct("fixed", "turns")))
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    last, so_far = F.last("told", ignorenulls=True).over(upto), F.coalesce(F.max("turns").over(upto), F.lit(0))
    # a key that begins with a flip was at 0 before, which is thrown down
    fixed = F.coalesce(last["fixed"], F.lit(-1))
    start = F.when((so_far - F.coalesce(last["turns"], F.lit(0))) % 2 == 0, fixed).otherwise(-fixed)
    starts = ends.select(*by, F.when(F.col("__segment") == 0, 0.0).otherwise(high * start).alias("__start"))
    acts = acts.join(starts, by).withColumn("__score", F.col("factor") * F.col("__start") + F.col("offset"))
    return filled(rows, acts.select(key, t, F.col("__score").alias("street_score")), key, t, "street_score", 0.0).drop("__slice")


def positioning(rows: DataFrame, key: str, t: str, trend: str, reports: str, half_life: float, width: int = 64) -> DataFrame:
    """``rows`` with ``positioning_pct``: eases on report days to ``50 + 40 tanh(2 trend)``, by the days since the last report."""
    rows = rows.withColumn("__slice", F.floor(F.col(t) / width))
    told = rows.where(F.col(reports)).select(key, t, "__slice", (50 + 40 * F.tanh(2 * F.col(trend))).alias("__target"))
    told = eased(told, [key], t, "__slice", F.col("__target"), half_life, 50.0, 0.0, "positioning_pct")
    return filled(rows, told.select(key, t, "positioning_pct"), key, t, "positioning_pct", 50.0).drop("__slice")


def filled(rows: DataFrame, values: DataFrame, key: str, t: str, value: str, start: float) -> DataFrame:
    """``rows`` (with ``__slice``) with the last ``value`` on or before each ``t``, ``start`` before the first one."""
    rows = rows.join(values, [key, t], "left")
    within = Window.partitionBy(key, "__slice").orderBy(t).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = rows.groupBy(key, "__slice").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(t))).alias("__value"))
    before = F.last("__value", ignorenulls=True).over(Window.partitionBy(key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1))
    last = last.withColumn("__before", before).drop("__value")
    return rows.withColumn(value, F.last(value, ignorenulls=True).over(within)).join(last, [key, "__slice"]).withColumn(value, F.coalesce(value, "__before", F.lit(start))).drop("__before")


def street_view(score: Column, threshold: float) -> Column:
    return F.when(score > threshold, "overweight").when(score < -threshold, "underweight").otherwise("neutral")


def crowding(pct: Column, low: float, high: float) -> Column:
    return F.when(pct > high, "crowded long").when(pct < low, "crowded short").otherwise("neutral")
