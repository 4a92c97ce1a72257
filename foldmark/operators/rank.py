"""Precedence, apportionment and keyed samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def precedence(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``status``: the first row of each group by ``order`` acted, the others were overridden."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("status", F.when(place == 1, "acted").otherwise("overridden"))


def largest_remainder(rows: DataFrame, keys: list[str], weight: str, total: str, tie: str) -> DataFrame:
    """``share``: ``total`` of each group split in whole parts by ``weight``; left-over ones go to the largest
    fractions (rounded to 9 places, so that noise breaks no tie), then to the earlier ``tie``."""
    group = Window.partitionBy(*keys)
    quota = F.try_divide(F.col(total) * F.col(weight), F.sum(weight).over(group))
    rows = rows.withColumn("__quota", F.coalesce(quota.cast("double"), F.lit(0.0))).withColumn("__whole", F.floor("__quota"))
    rest = F.col(total) - F.sum("__whole").over(group)
    place = F.row_number().over(group.orderBy(F.when(F.col(weight) > 0, 0).otherwise(1), F.round(F.col("__quota") - F.col("__whole"), 9).desc(), tie))
    share = F.col("__whole") + F.when((place <= rest) & (F.col(weight) > 0), 1).otherwise(0)
    return rows.withColumn("share", share.cast("long")).drop("__quota", "__whole")


def keyed_order(seed: str, *columns: str) -> Column:
    """A key that orders rows at random, the same wherever it is computed."""
    return F.sha2(F.concat_ws("|", F.lit(seed), *(F.col(c).cast("string") for c in columns)), 256)


def stratified_sample(rows: DataFrame, stratum: str, n: int, seed: str, key: str) -> DataFrame:
    """``n`` rows of each stratum without replacement, by the keyed order."""
    place = F.row_number().over(Window.partitionBy(stratum).orderBy(keyed_order(seed, key), key))
    return rows.withColumn("__place", place).where(F.col("__place") <= n).drop("__place")


def opaque_id(key: str, column: str) -> Column:
    return F.concat(F.lit("q_"), F.substring(F.sha2(F.concat_ws(":", F.lit(key), F.col(column).cast("string")), 256), 1, 16))


def uniform(seed: str, *columns: str) -> Column:
    """A number in [0, 1) from the keys of a row: adding a purpose or a row changes no other draw."""
    return F.conv(F.substring(keyed_order(seed, *columns), 1, 13), 16, 10).cast("double") / float(1 << 52)
