"""Greatest overlap of a subject with any single other one, over sets of grams."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmark.sources.scratch import cut

RARE = 20
#: grams of subjects that one task holds of either side, and the least number of blocks
BLOCK_GRAMS, LEAST_BLOCKS = 2_000_000, 4


def nearest_other(grams: DataFrame, by: str, rare: int = RARE) -> DataFrame:
    """``by, own, shared``: how many of a subject's ``grams`` (by, gram; distinct) it has, and the most that one other has too.

    No row is made for a pair. Subjects of one content are one row; grams that only one of these holds are left out, and
    the others are one list for each subject, of 64-bit hashes (that two of n such grams are taken for one has a chance
    of n * n / 2**65). Lists are dealt into blocks by their subject, and each block meets each in one cell, of a size that
    does not grow (``_greatest``). So only lists travel, once for each block of the other side. ``rare``: grams that at
    most so many subjects of a block hold are looked at first.
    """
    content = cut(grams.groupBy(by).agg(F.count("*").alias("own"), F.sum(F.xxhash64("gram").cast("decimal(38,0)")).alias("content")))
    one = content.groupBy("content").agg(F.min(by).alias("rep"), F.count("*").alias("copies"), F.first("own").alias("own"))
    g = grams.withColumnRenamed(by, "rep").join(one.select("rep"), "rep", "left_semi")
    held = g.withColumn("n", F.count("*").over(Window.partitionBy("gram"))).where("n > 1")
    lists = cut(held.groupBy("rep").agg(F.collect_list(F.xxhash64("gram")).alias("grams")))
    total = lists.agg(F.sum(F.size("grams"))).first()[0] or 0
    blocks = max(LEAST_BLOCKS, -(-total // BLOCK_GRAMS))
    dealt = lists.withColumns({"block": F.pmod(F.xxhash64("rep"), F.lit(blocks)), "other": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    asked = dealt.select((F.col("block") * blocks + F.col("other")).alias("cell"), "rep", "grams")
    others = dealt.select((F.col("other") * blocks + F.col("block")).alias("cell"), "rep", "grams")
    schema = T.StructType([T.StructField("rep", grams.schema[by].dataType), T.StructField("best", T.LongType())])
    best = asked.groupBy("cell").cogroup(others.groupBy("cell")).applyInPandas(_greatest(rare), schema).groupBy("rep").agg(F.max("best").alias("best"))
    found = one.join(best, "rep", "left").select("content", F.expr("if(copies > 1, own, coalesce(best, 0L))").alias("shared"))
    return content.join(found, "content").select(by, "own", "shared")


def _greatest(rare: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The greatest overlap of each asked list with one list of the other block.

    The rarest grams give a first overlap ``b``. Whoever shares more than ``b`` of ``c`` grams holds one of any ``c - b``
    of them, so only holders of the rarest ``c - b`` are looked at, and of these the rest is counted by the grams that
    are left or by their own lists, whichever is less.
    """

    def spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """All places from each start to before its end."""
        n = ends - starts
        return np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())

    def cell(asked: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        best = np.zeros(len(asked), dtype=np.int64)
        if len(asked) and len(others):
            size = others["grams"].str.len().to_numpy()
            names, grams = np.unique(np.concatenate(others["grams"].to_numpy()), return_inverse=True)
            to = np.cumsum(size)
            at = to - size
            holders = np.repeat(np.arange(len(others)), size)[np.argsort(grams, kind="stable")]
            last = np.cumsum(np.bincount(grams, minlength=len(names)))
            first = np.concatenate([[0], last[:-1]])
            place, marked = {rep: k for k, rep in enumerate(others["rep"])}, np.zeros(len(names), dtype=bool)
            count = lambda g: np.bincount(holders[spans(first[g], last[g])], minlength=len(others))
            for k, (rep, own) in enumerate(zip(asked["rep"], asked["grams"])):
                i = np.minimum(np.searchsorted(names, own), len(names) - 1)
                g = i[names[i] == own]
                n = last[g] - first[g]
                order = np.argsort(n, kind="stable")
                g, n, me = g[order], n[order], place.get(rep)
                if me is not None:  # nobody's holder of its own grams
                    g, n = g[n > 1], n[n > 1]
                marked[g] = True
                b, few = 0, g[: np.searchsorted(n, rare, "right")]
                if len(few):
                    found = count(few)
                    if me is not None:
                        found[me] = 0
                    top = found.argmax()
                    b = int(marked[grams[at[top] : to[top]]].sum()) if found[top] else 0
                if len(g) > b:
                    found, rest = count(g[: len(g) - b]), g[len(g) - b :]
                    if me is not None:
                        found[me] = 0
                    near = np.flatnonzero(found)
                    if len(near) and n[len(g) - b :].sum() <= size[near].sum():
                        b = max(b, int((found + count(rest))[near].max()))
                    elif len(near):
                        theirs = marked[grams[spans(at[near], to[near])]]
                        b = max(b, int(np.add.reduceat(theirs, np.cumsum(size[near]) - size[near], dtype=np.int64).max()))
                marked[g] = False
                best[k] = b
        return pd.DataFrame({"rep": asked["rep"], "best": best})

    return cell
