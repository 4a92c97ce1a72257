"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.llm.common import dropped, recorded, written


def components(links: DataFrame) -> DataFrame:
    """``v, label`` for each end of ``links`` (a, b): the least end of its component.

    Every end has a parent, at first itself. In a round each end looks at the grandparents of its neighbours;
    the least of them becomes its parent and, which keeps long paths short, that of its old parent as well; then
    it skips to its own grandparent. So whole trees hook onto others and halve: the rounds grow with the
    logarithm of a component's width. Each round is written to the shared folder and takes the place of the
    one before; only a sign of change reaches the driver.
    """
    return rounds(links)[0]


def rounds(links: DataFrame) -> tuple[DataFrame, int]:
    """:func:`components`, and how many rounds it took."""
    both = links.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(links.select(F.col("b").alias("v"), F.col("a").alias("u")))
    both = written(both.where("v <> u").distinct(), "links")
    parents, old, n = both.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("p")), [], 0
    with recorded() as made:
        parents = written(parents, "parents")
    while True:
        n += 1
        old = made
        grand = parents.join(parents.select(F.col("v").alias("p"), F.col("p").alias("g")), "p").select("v", "p", "g")
        near = both.join(grand.select(F.col("v").alias("u"), "g"), "u").groupBy("v").agg(F.min("g").alias("m"))
        with recorded() as made:
            seen = written(grand.join(near, "v"), "seen")
            hooks = seen.groupBy(F.col("p").alias("v")).agg(F.min("m").alias("h"))
            new = written(seen.join(hooks, "v", "left").select("v", F.col("p").alias("old"), F.least("p", "m", "g", "h").alias("p")), "parents")
        if new.where("p <> old").isEmpty():
            dropped(links.sparkSession, [*old, made[0]])
            return new.select("v", F.col("p").alias("label")), n
        parents = new.select("v", "p")
        dropped(links.sparkSession, [*old, made[0]])
        made = made[1:]
