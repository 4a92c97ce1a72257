"""Scalar rules as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(x: Column) -> Column:
    return F.floor(x + 0.5)


def quotient(a: Column, b: Column) -> Column:
    """``a / b`` of doubles, infinite or NaN where ``b`` is zero, by its sign."""
    return F.when(b == 0, a * F.pow(b, F.lit(-1.0))).otherwise(F.try_divide(a, b))


def whole(x: Column) -> Column:
    """The floor of a double as a double: beyond 2^53 all are whole, and neither infinities nor NaN fit into a long."""
    return F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)


def log(x: Column) -> Column:
    """The natural logarithm, minus infinity for zero and NaN below; null for null alone."""
    return F.when(x == 0, F.lit(float("-inf"))).when(x < 0, F.lit(float("nan"))).otherwise(F.ln(x))


def nearest(x: Column, places: int) -> Column:
    """``x`` rounded as SQL engines round a double: scaled, the nearest whole number, halves away from zero, and scaled back.
    ``F.round`` goes by the digits that are shown, which gives other doubles for large ones, and no zero with a sign."""
    y = x * 10.0**places
    r = F.rint(y)
    r = F.when((y > 0) & (y - r == 0.5), r + 1).when((y < 0) & (y - r == -0.5), r - 1).otherwise(r)
    return F.when(F.abs(y) < float("inf"), r / 10.0**places).otherwise(x)


def printed(x: Column, places: int, signed: bool = False) -> Column:
    """``x`` as C prints it, by its exact value, exact halves to even; infinities and NaN are ``inf`` and ``nan``, signed as
    numbers are. ``F.format_string`` goes by the digits that are shown: it makes 1.01 of 1.005, which is less than that."""
    plus, form = "+" if signed else "", "0." + "0" * places
    text = F.call_function("format_number", x, F.lit(f"{plus}{form};-{form}"))
    return F.when(F.isnan(x), f"{plus}nan").when(x == float("inf"), f"{plus}inf").when(x == float("-inf"), "-inf").otherwise(text)


def regime_multiplier(rate: Column, c: Column) -> Column:
    """A rate moved by ``ln(c)`` on the logit scale, kept off 0 and 1."""
    p = F.least(F.greatest(rate, F.lit(1e-6)), F.lit(1 - 1e-6))
    z = F.ln(p / (1 - p)) + F.ln(c)
    return F.least(F.greatest(1 / (1 + F.exp(-z)), F.lit(1e-6)), F.lit(1 - 1e-6))


def blend(own: Column, other: Column, weight: Column) -> tuple[Column, Column]:
    """The weighted mean of two forecasts, and the same at unit variance."""
    mean = (1 - weight) * own + weight * other
    return mean, mean / F.sqrt((1 - weight) * (1 - weight) + weight * weight)


def sell_hazard(base: Column, progress: Column, ratio: Column, gain: Column) -> Column:
    """Gains are sold the sooner, losses the later, by the root of ``ratio``; within 0 and 1."""
    h = base * (1 + progress) * F.when(gain, F.sqrt(ratio)).otherwise(1 / F.sqrt(ratio))
    return F.least(F.greatest(h, F.lit(0.0)), F.lit(1.0))


def bucket(x: Column, cuts: list[float]) -> Column:
    """1 below the first cut, one more at and above each."""
    out = F.lit(1)
    for c in cuts:
        out = out + F.when(x >= c, 1).otherwise(0)
    return out


def normal_quantile(p: Column) -> Column:
    """Acklam's rational approximation of the inverse normal distribution (relative error under 1.2e-9)."""
    # fixed values: published coefficients
    a = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
    b = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0)
    c = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
    d = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)

    def poly(x: Column, k: tuple[float, ...]) -> Column:
        out = F.lit(k[0])
        for v in k[1:]:
            out = out * x + v
        return out

    q, low = p - 0.5, F.sqrt(-2 * F.ln(F.least(p, 1 - p)))
    tail = poly(low, c) / poly(low, d)
    return F.when(F.least(p, 1 - p) < 0.02425, F.when(p < 0.5, tail).otherwise(-tail)).otherwise(q * poly(q * q, a) / poly(q * q, b))
