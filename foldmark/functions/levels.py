"""Levels of series and legs of trades, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foldmark.functions import numbers

#: fixed values: unit of a level, decimals and text behind it
UNITS = {"pct": (2, "%"), "bp": (1, "bp")}


def raw_level(kind: Column, price: Column) -> Column:
    """Level in the unit that moves add up in: 100 ln of a price or futures level, a yield in basis points, a spread as it is.
    A price of zero has a level, too: minus infinity."""
    return F.when(kind.isin("equity", "commodity", "future"), 100 * numbers.log(price)).when(kind == "sovereign", 100 * price).when(kind == "credit", price)


def level_text(level: Column, unit: Column, price_quoted: Column) -> Column:
    """As a trader quotes it: a price for what is quoted in prices, else the level with its unit; null for an unknown unit."""
    out = F.lit(None).cast("string")
    for name, (places, behind) in UNITS.items():
        out = F.when(unit == name, F.concat(numbers.printed(level, places), F.lit(behind))).otherwise(out)
    return F.when(price_quoted, numbers.printed(F.exp(level / 100), 2)).otherwise(out)


def move_text(move: Column, unit: Column) -> Column:
    """A signed move, without its unit."""
    out = F.lit(None).cast("string")
    for name, (places, _) in UNITS.items():
        out = F.when(unit == name, numbers.printed(move, places, signed=True)).otherwise(out)
    return out


def leg_side(position: Column, bullish: Column, weight: Column, leg_bullish: Column) -> Column:
    """``long`` or ``short`` for a leg: the signs of the position, of what a rise means and of the leg's weight multiply."""
    sign = F.signum(position * bullish * weight * leg_bullish)
    return F.when(sign > 0, "long").when(sign < 0, "short")


def size_and_risk(kind: Column, share: Column, price: Column, book: Column, per_unit: Column) -> Column:
    """``size`` and ``risk`` of a leg that takes ``share`` percent of the ``book``: an equity's size is that share, a rate's its
    amount in millions times the value of a basis point, a commodity's whole contracts, one at least (``per_unit`` is the
    value of a basis point, or a contract's multiplier). What costs nothing is held without end: an infinite size."""
    amount = book * share / 100
    size = F.when(kind == "equity", share).when(kind == "commodity", F.greatest(F.lit(1.0), numbers.whole(numbers.quotient(amount, price * per_unit)))).otherwise(amount / 1e6 * per_unit)
    return F.struct(size.alias("size"), amount.alias("risk"))
