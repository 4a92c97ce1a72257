"""All estimators of all splits in one scan: a registry of shares, their cells, verdicts and what blocks.

An estimator says which rows are opportunities and which of these are hits. All of a table's estimators are one
aggregate over the splits of its rows, so adding one adds no scan and no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.operators import cells


@dataclass(frozen=True)
class Estimator:
    """A share of ``opportunity`` rows that are a ``hit``; ``counts`` tells opportunities that are only counted.

    With ``value``, an aggregate in SQL, the estimate is that instead. ``blocking``: its cross-class cell must pass.
    """

    param: str
    opportunity: str
    hit: str = "false"
    counts: str | None = None
    value: str | None = None
    blocking: bool = True


def loss_aversion(last_day: str = "last_day") -> Estimator:
    """Adds among the days at a loss that are open to an add: no trigger pending, no roll, a next day to act on. Days on
    which the subject's own rule forbids an add are counted as opportunities but are not estimated from."""
    at_loss = f"pnl_state = 'loss' AND NOT trigger_pending AND action <> 'roll' AND day <> {last_day}"
    return Estimator("loss_aversion", f"{at_loss} AND NOT (no_add AND triggers_fired = 0)", "action = 'add'", counts=at_loss)


def split_rows(rows: DataFrame, splits: dict[str, str]) -> DataFrame:
    """Each row once in every split whose condition holds; the split ``all`` is stated like the others."""
    held = F.array_compact(F.array(*(F.when(F.expr(condition), F.lit(name)) for name, condition in splits.items())))
    return rows.withColumn("split", F.explode(held))


def estimate_all(rows: DataFrame, subject: list[str], estimators: Iterable[Estimator], splits: dict[str, str]) -> DataFrame:
    """``subject, split, param, value, n, n_counted``: one scan and one shuffle for all; null where nothing was an opportunity."""
    estimators = list(estimators)
    if len({e.param for e in estimators}) < len(estimators):
        raise ValueError("a parameter is estimated twice")
    count = lambda e: F.count_if(F.expr(e))
    parts = [
        F.struct(
            F.lit(e.param).alias("param"),
            (F.try_divide(count(f"({e.opportunity}) AND ({e.hit})"), count(e.opportunity)) if e.value is None else F.expr(e.value)).cast("double").alias("value"),
            count(e.opportunity).alias("n"), count(e.counts or e.opportunity).alias("n_counted"),
        )
        for e in estimators
    ]
    found = split_rows(rows, splits).groupBy(*subject, "split").agg(F.array(*parts).alias("e"))
    return found.select(*subject, "split", F.inline("e"))


def judged(estimates: DataFrame, traits: DataFrame, subject: str, group: str) -> DataFrame:
    """``param, split, kind, cell`` with their statistics and verdict: ``estimates`` (of :func:`estimate_all`) with ``traits``
    (subject, param, active, group), pooled over all and by group."""
    rows = estimates.join(traits, [subject, "param"]).withColumn("key", F.concat_ws("/", "param", "split"))
    members = cells.memberships(rows, {group: group}).withColumns({"cell": F.concat_ws("|", "key", "cell")})
    found = cells.gate_cells(members).withColumns({"param": F.split("cell", "[/|]")[0], "split": F.split("cell", "[/|]")[1], "group": F.split("cell", "[|]")[1]})
    return found.drop("cell")


def blocking_failures(found: DataFrame, estimators: Iterable[Estimator]) -> DataFrame:
    """``failure``: ``all/param`` of each blocking cell over all subjects that does not pass, ``all/param: missing`` where a
    blocking parameter has none."""
    params = [e.param for e in estimators if e.blocking]
    spark = found.sparkSession
    wanted = spark.createDataFrame([(p,) for p in params], "param string")
    pooled = found.where((F.col("kind") == "pool") & (F.col("split") == "all")).select("param", "verdict")
    rows = F.broadcast(wanted).join(pooled, "param", "left")  # the registry is a stated list
    said = F.when(F.col("verdict").isNull(), F.concat(F.lit("all/"), "param", F.lit(": missing"))).when(F.col("verdict") != "pass", F.concat(F.lit("all/"), "param"))
    return rows.select(said.alias("failure")).where(F.col("failure").isNotNull())
