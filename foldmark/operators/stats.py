"""Tests and agreement measures as aggregates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


QUANTILES = 64


def cumulated(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys, value, n, upto``: how often each value of ``value`` occurs, and how many rows have it or a smaller one.

    Equal values are counted first; the distinct ones of a key are dealt by its quantiles, each part is cumulated on
    its own, and the parts' totals, a few for each key, come before them. So no task sorts a whole key.
    """
    counts = rows.groupBy(*keys, value).agg(F.count("*").alias("n"))
    cuts = counts.groupBy(*keys).agg(F.percentile_approx(value, [k / QUANTILES for k in range(1, QUANTILES)], 1000).alias("__cuts"))
    join = (lambda x, y: x.join(y, keys)) if keys else (lambda x, y: x.crossJoin(F.broadcast(y)))  # without keys it is one row
    parts = join(counts, cuts).withColumn("__part", F.expr(f"size(filter(__cuts, c -> c < `{value}`))")).drop("__cuts")
    totals = parts.groupBy(*keys, "__part").agg(F.sum("n").alias("__total"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "__part", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"))
    upto = Window.partitionBy(*keys, "__part").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return parts.join(totals, [*keys, "__part"]).select(*keys, value, "n", (F.sum("n").over(upto) + F.col("__before")).alias("upto"))


def average_ranks(rows: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """``keys, value, out``: the rank of each value, equal ones sharing the mean of theirs."""
    return cumulated(rows, keys, value).select(*keys, value, (F.col("upto") - (F.col("n") - 1) / 2).alias(out))


def quantiles(rows: DataFrame, value: str, nearest: float) -> DataFrame:
    """``n, median, at, most`` of ``value``: the mean of the two middle values, that of the rank nearest above ``nearest``, and the greatest."""
    counted = cumulated(rows.where(F.col(value).isNotNull()), [], value).crossJoin(F.broadcast(rows.agg(F.count(value).alias("all_"))))
    at = lambda rank: F.min(F.when(F.col("upto") >= rank, F.col(value)))
    middle = (at(F.expr("(all_ + 1) div 2")) + at(F.expr("all_ div 2 + 1"))) / 2
    return counted.agg(F.coalesce(F.max("upto"), F.lit(0)).alias("n"), middle.alias("median"), at(F.ceil(F.col("all_") * nearest)).alias("at"), F.max(value).alias("most"))


def correlation(x: str, y: str) -> Column:
    """Pearson's, null where a side is constant or single."""
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def spearman(rows: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """``rho`` of each group, null under 3 rows."""
    rows = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, x, y)
    pairs = rows.groupBy(*keys, x, y).agg(F.count("*").alias("__w"))
    ranked = pairs.join(average_ranks(rows, keys, x, "rx"), [*keys, x]).join(average_ranks(rows, keys, y, "ry"), [*keys, y])
    # equal pairs were counted; the moments are weighted by how many there are
    w, rx, ry = F.col("__w"), F.col("rx"), F.col("ry")
    n, total = F.sum(w), lambda c: F.sum(w * c)
    middle = (n + 1) / 2  # of ranks, whatever the ties
    ranked = ranked.groupBy(*keys).agg(n.alias("n"), total((rx) * (ry)).alias("xy"), total(rx * rx).alias("xx"), total(ry * ry).alias("yy"), middle.alias("m"))
    centred = lambda c: F.col(c) - F.col("n") * F.col("m") * F.col("m")
    rho = F.try_divide(centred("xy"), F.sqrt(centred("xx")) * F.sqrt(centred("yy")))
    return ranked.select(*keys, "n", F.when(F.col("n") >= 3, rho).alias("rho"))


def log_factorial(n: str) -> str:
    """SQL for the logarithm of ``n``! of any size: Stirling's series, whose error from 16 on is under 1e-11, and a few exact ones.

    As doubles go, it is good to about n ln(n) * 1e-16: a millionth for cells of 10**8, a hundredth for 10**12."""
    exact = ", ".join(f"{math.lgamma(k + 1)!r}D" for k in range(16))
    x = f"cast({n} AS double)"
    series = f"({x} + 0.5D) * ln({x}) - {x} + {math.log(2 * math.pi) / 2!r}D + 1D / (12D * {x}) - 1D / (360D * {x} * {x} * {x}) + 1D / (1260D * pow({x}, 5D))"
    return f"(CASE WHEN {n} < 16 THEN element_at(array({exact}), int({n}) + 1) ELSE {series} END)"


def fisher_upper(hits: str, active: str, inactive: str, present: str) -> Column:
    """P(at least ``hits`` of ``present`` drawn are active) under random draws; names of long columns."""
    choose = lambda n, k: f"({log_factorial(f'({n})')} - {log_factorial(f'({k})')} - {log_factorial(f'({n} - {k})')})"
    low, high = f"greatest({hits}, {present} - {inactive}, 0L)", f"least({active}, {present})"
    first = f"{choose(active, low)} + {choose(inactive, f'({present} - {low})')} - {choose(f'({active} + {inactive})', present)}"
    # each further chance follows from the one before it, so the sum takes time in proportion to its terms
    ratio = f"ln(greatest(cast(({active} - k) AS double) * ({present} - k) / ((k + 1D) * greatest({inactive} - {present} + k + 1, 1)), 1e-300D))"
    step = f"(s, k) -> named_struct('t', s.t + {ratio}, 'p', s.p + exp(s.t))"
    return F.expr(f"if({low} > {high}, 0D, least(1D, aggregate(sequence({low}, greatest({low}, {high})), named_struct('t', {first}, 'p', 0D), {step}, s -> s.p)))")


def poisson_binomial_upper(chances: str, hits: str) -> Column:
    """P(at least ``hits`` successes) of independent tries with the array ``chances``."""
    step = "(d, p) -> transform(sequence(0, size(d)), i -> coalesce(get(d, i), 0D) * (1 - p) + if(i > 0, coalesce(get(d, i - 1), 0D), 0D) * p)"
    dist = f"aggregate({chances}, array(1D), {step})"
    return F.expr(f"least(1D, greatest(0D, aggregate(slice({dist}, int({hits}) + 1, size({chances}) + 1), 0D, (a, x) -> a + x)))")


def kappa(rows: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Cohen's kappa of two 0/1 columns; null where chance agreement is certain."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    agree = F.avg(F.when(F.col(a) == F.col(b), 1.0).otherwise(0.0))
    chance = F.avg(x) * F.avg(y) + (1 - F.avg(x)) * (1 - F.avg(y))
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), agree.alias("agreement"), F.try_divide(agree - chance, 1 - chance).alias("kappa"))
