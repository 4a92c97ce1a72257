"""Audits of a calendar and of a map of checks: what was promised against what is there."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.operators.recurrence import with_previous


def count_metrics(rows: DataFrame, expected: DataFrame, kind: str) -> DataFrame:
    """``kind, target, realised, passed`` for each kind that is expected (kind, n) or there: counts must be equal, kind by kind."""
    there = rows.where(F.col(kind).isNotNull()).groupBy(kind).agg(F.count("*").alias("realised"))
    both = expected.select(kind, F.col("n").cast("long").alias("target")).join(there, kind, "full")
    both = both.withColumns({"target": F.coalesce("target", F.lit(0)), "realised": F.coalesce("realised", F.lit(0))})
    return both.withColumn("passed", F.col("target") == F.col("realised"))


def spacing_metrics(rows: DataFrame, subjects: DataFrame, key: str, day: str, weeks: int, per_year: int = 3, unit: str = "MONTH") -> DataFrame:
    """``key, n, least, covered, smallest_gap, largest_gap`` for each of ``subjects``: its different days, whether there are at
    least ``per_year`` of them for every 52 of the ``weeks`` (and one), and the days between neighbours; null with under two."""
    days = rows.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select(key, F.to_date(day).alias("__day")).distinct()
    days = with_previous(days.withColumn("__slice", F.date_trunc(unit, "__day")), [key], "__day", "__slice", "__last")
    gap = F.datediff("__day", "__last").cast("long")
    found = days.groupBy(key).agg(F.count("*").alias("n"), F.min(gap).alias("smallest_gap"), F.max(gap).alias("largest_gap"))
    least = max(1, math.floor(per_year * weeks / 52))
    n = F.coalesce("n", F.lit(0))
    return subjects.select(key).distinct().join(found, key, "left").select(key, n.alias("n"), F.lit(least).cast("long").alias("least"), (n >= least).alias("covered"), "smallest_gap", "largest_gap")


def map_faults(catalogue: DataFrame, check_map: DataFrame, kinds: list[str]) -> DataFrame:
    """``param, value, fault`` where a map of checks (param, value, kind) and a catalogue (param, value) do not cover each
    other: values without an entry, entries for no value, parameters without any entry, kinds that no check has."""
    params = catalogue.select("param").distinct()
    mapped = check_map.select("param").distinct()
    lost = params.join(mapped, "param", "left_anti").select("param", F.lit(None).cast("string").alias("value"), F.lit("no entry for the parameter").alias("fault"))
    values = catalogue.select("param", "value").distinct().join(mapped, "param", "left_semi")
    missing = values.join(check_map.select("param", "value"), ["param", "value"], "left_anti").withColumn("fault", F.lit("no entry for the value"))
    extra = check_map.select("param", "value").join(catalogue.select("param", "value").distinct(), ["param", "value"], "left_anti").withColumn("fault", F.lit("not in the catalogue"))
    odd = check_map.where(~F.coalesce(F.col("kind").isin(kinds), F.lit(False))).select("param", "value", F.concat(F.lit("unknown kind: "), F.coalesce("kind", F.lit("none"))).alias("fault"))
    return lost.unionByName(missing).unionByName(extra).unionByName(odd)


def share_cells(rows: DataFrame, slices: dict[str, str], hit: str) -> DataFrame:
    """``slice, slice_value, n, n_positive, rate``: bare shares over all rows and by each of ``slices`` (name: column), never tested."""
    cells = [F.struct(F.lit("all").alias("slice"), F.lit("all").alias("slice_value"))]
    cells += [F.struct(F.lit(name).alias("slice"), F.coalesce(F.col(column).cast("string"), F.lit("none")).alias("slice_value")) for name, column in slices.items()]
    found = rows.withColumn("c", F.explode(F.array(*cells))).groupBy("c.slice", "c.slice_value").agg(F.count("*").alias("n"), F.count_if(F.expr(hit)).alias("n_positive"))
    return found.withColumn("rate", F.col("n_positive") / F.col("n"))
