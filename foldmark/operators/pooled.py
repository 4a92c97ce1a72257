"""Cells of tries whose chances differ: the Poisson-binomial tail, for cells of any size.

A cell is an aggregate that merges: how often each chance occurs. The tries of one chance are a binomial, of which
only what weighs more than rounding is kept; these are convolved by halves. No list of tries is collected.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Standard deviations, and tries on top, beyond which a binomial weighs less than 1e-30.
REACH, EXTRA = 12.0, 60


def _binomial(n: int, p: float) -> tuple[int, np.ndarray]:
    """The first number of successes that counts, and the chances from there on."""
    if p <= 0 or p >= 1 or not n:
        return (n if p >= 1 else 0), np.ones(1)
    reach = REACH * math.sqrt(n * p * (1 - p)) + EXTRA
    low, high = max(0, int(n * p - reach)), min(n, int(n * p + reach))
    k = np.arange(low, high)
    # each chance follows from the one before, by logarithms from the most likely one on
    steps = np.log((n - k) / (k + 1)) + math.log(p / (1 - p))
    logs = np.append(0.0, np.cumsum(steps))
    mode = int(np.argmax(logs))
    at = low + mode
    top = math.lgamma(n + 1) - math.lgamma(at + 1) - math.lgamma(n - at + 1) + at * math.log(p) + (n - at) * math.log1p(-p)
    return low, np.exp(logs - logs[mode] + top)


def _convolved(parts: list[tuple[int, np.ndarray]]) -> tuple[int, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    (a, x), (b, y) = _convolved(parts[:half]), _convolved(parts[half:])
    z = np.convolve(x, y)
    keep = np.flatnonzero(z > 1e-40)  # nothing of the tails that could show
    first, last = (int(keep[0]), int(keep[-1]) + 1) if len(keep) else (0, len(z))
    return a + b + first, z[first:last]


def upper_tail(chances: list[tuple[float, int]], hits: int) -> float:
    """P(at least ``hits`` successes) for tries of the given (chance, number)."""
    n = sum(c for _, c in chances)
    if hits <= 0:
        return 1.0
    if hits > n:
        return 0.0
    if hits == n:
        return math.exp(sum(c * math.log(p) for p, c in chances)) if all(p > 0 for p, _ in chances) else 0.0
    first, mass = _convolved([_binomial(c, p) for p, c in sorted(chances, key=lambda x: x[1])])
    return float(min(1.0, max(0.0, mass[max(0, hits - first) :].sum())))


def upper_tail_column(mix: Column, hits: Column) -> Column:
    """:func:`upper_tail` of an array of structs (chance, n)."""

    @F.pandas_udf("double")
    def tail(mixes: pd.Series, wanted: pd.Series) -> pd.Series:
        return pd.Series([upper_tail([(c["chance"], int(c["n"])) for c in m], int(k)) for m, k in zip(mixes, wanted, strict=True)], dtype=float)

    return tail(mix, hits)


def pooled_cells(tries: DataFrame, by: list[str], alpha: float, least: int) -> DataFrame:
    """``by, n, n_positive, rate, chance, p, verdict`` of ``tries`` (by, chance, hit): whether a cell has more hits than its chances give.

    Insufficient, without a p, under ``least`` tries, and where not even all hits would be less likely than ``alpha``.
    Tries with a null chance or outcome count nowhere.
    """
    tries = tries.where(F.col("chance").isNotNull() & F.col("hit").isNotNull())
    equal = tries.groupBy(*by, F.col("chance").cast("double").alias("chance")).agg(F.count("*").alias("n"), F.count_if("hit").alias("hits"))
    cells = equal.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("hits").alias("n_positive"), F.sum(F.col("n") * F.col("chance")).alias("expected"), F.sum(F.col("n") * F.log("chance")).alias("log_all"), F.collect_list(F.struct("chance", "n")).alias("mix")
    )
    enough = (F.col("n") >= least) & (F.exp("log_all") < alpha)
    cells = cells.withColumn("enough", enough).withColumn("p", upper_tail_column(F.when(F.col("enough"), F.col("mix")).otherwise(F.array().cast(cells.schema["mix"].dataType)), F.col("n_positive")))
    p = F.when(F.col("enough"), F.col("p"))
    return cells.select(
        *by, "n", "n_positive", (F.col("n_positive") / F.col("n")).alias("rate"), (F.col("expected") / F.col("n")).alias("chance"), p.alias("p"),
        F.when(~F.col("enough"), "insufficient").when(F.col("p") < alpha, "pass").otherwise("fail").alias("verdict"),
    )
