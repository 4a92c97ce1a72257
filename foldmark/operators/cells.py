"""Cells: overlapping groups of estimates, compared and judged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: thresholds of the verdicts
FLOOR_SE, GAP_FRACTION, MIN_SUBJECTS, MIN_POP_Z = 2.0, 0.5, 5, 3.0


def memberships(estimates: DataFrame, groups: dict[str, str]) -> DataFrame:
    """Each estimate once in the pool and once in the cell of each of ``groups`` (kind: column)."""
    cells = [F.struct(F.lit("pool").alias("kind"), F.lit("all").alias("cell"))]
    cells += [F.struct(F.lit(kind).alias("kind"), F.col(column).cast("string").alias("cell")) for kind, column in groups.items()]
    return estimates.withColumn("c", F.explode(F.array(*cells))).select("*", "c.kind", "c.cell").drop("c")


def gate_cells(members: DataFrame) -> DataFrame:
    """Statistics and verdict of each (kind, cell) of ``members`` (value, active); null values are counted as missing."""
    on = ["kind", "cell"]
    neutral, active = F.when(~F.col("active"), F.col("value")), F.when(F.col("active"), F.col("value"))
    cells = members.groupBy(*on).agg(
        F.count(neutral).alias("n_neutral"), F.count(active).alias("n_active"), F.count(F.when(F.col("value").isNull(), 1)).alias("n_missing"),
        F.avg(neutral).alias("neutral_mean"), F.stddev_samp(neutral).alias("neutral_sd"), F.avg(active).alias("active_mean"), F.stddev_samp(active).alias("active_sd"),
    ).withColumn("floor", F.col("neutral_mean") + FLOOR_SE * F.col("neutral_sd"))
    past = members.where("active AND value IS NOT NULL").join(cells.select(*on, "floor"), on).groupBy(*on).agg(F.avg(F.when(F.col("value") > F.col("floor"), 1.0).when(F.col("floor").isNotNull(), 0.0)).alias("share_past_floor"))
    gap = F.col("active_mean") - F.col("neutral_mean")
    cells = cells.join(past, on, "left").withColumn("pop_z", F.expr("try_divide(active_mean - neutral_mean, sqrt(neutral_sd * neutral_sd / n_neutral + active_sd * active_sd / n_active))"))
    cells = cells.withColumn("gap_ok", F.coalesce((gap > 0) & (F.col("neutral_sd") <= GAP_FRACTION * F.abs(gap)), F.lit(False))).withColumn("pop_ok", F.coalesce(F.col("pop_z") >= MIN_POP_Z, F.lit(False)))
    verdict = F.when((F.col("n_neutral") < MIN_SUBJECTS) | (F.col("n_active") < MIN_SUBJECTS), "insufficient").when(F.col("pop_ok"), "pass").otherwise("fail")
    return cells.withColumn("verdict", verdict).drop("active_sd")
