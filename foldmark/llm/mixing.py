"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions only.

Leaves are (domain, lang, source). A token budget goes down the tree by the weights of the nodes. A node
that cannot use its share (all its tokens, ``max_epochs`` times) hands the rest to its siblings in
proportion to their weights, and only what all siblings cannot use reaches their parent's siblings. As
what a node can use is known beforehand, that is a water level among siblings, top down:
``least(capacity, weight * level)`` with the level at which a parent's budget is used up.

A leaf's budget buys whole epochs, then a prefix of the next: its documents in the order of a hash of
(seed, epoch, doc_id, text) while their tokens fit. The end of the prefix is found in three steps, sums of
groups of ``GROUP`` slots, of the slots in one group (about ``SLOT`` documents each), and of the different documents
of the one slot where the budget ends, so a leaf with a third of all documents is never sorted in one task.
Tokens are counted as words between white space: budgets are shares, and no tokenizer is a DataFrame function.

Defined results: null texts have no tokens and are taken with their leaf's prefix; a null or unknown
domain, lang or source is a node of its own with the default weight; weights of zero or less get
nothing; rows equal in id and text are taken or left together; a very long text is counted whole; columns that
are not asked for, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmark.llm.common import column_or_null, written

LEVELS = ("domain", "lang", "source")
SLOT, GROUP, BROADCAST_LEAVES = 1000, 1000, 100_000  # documents in a slot, slots in a group
SEED, MAX_EPOCHS, SHARE = 17, 2, 0.6
#: Weights by level; other nodes have 1.
WEIGHTS: dict[str, dict[str, float]] = {"domain": {"d0": 4.0, "d1": 3.0, "d2": 2.0}, "lang": {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 2.0}, "source": {}}


def domain_of(source: str = "source") -> Column:
    """The test tables have no domains; the last digits of a source's name stand in for one."""
    return F.coalesce(F.concat(F.lit("d"), (F.expr(f"try_cast(regexp_extract({source}, '([0-9]{{1,9}})$', 1) AS int)") % 3).cast("string")), F.lit("none"))


def _weight(level: str, weights: dict[str, dict[str, float]]) -> Column:
    out = F.lit(1.0)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(float(w))).otherwise(out)
    return F.greatest(out, F.lit(0.0))


def order_key(epoch: Column, seed: int = SEED) -> Column:
    """60 bits that order the documents of an epoch."""
    line = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("digest"))
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 15), 16, 10).cast("long")


def keyed(docs: DataFrame, domain: Column | None = None) -> DataFrame:
    """``doc_id``, the leaf, number of tokens and digest of each document."""
    text = column_or_null(docs, "text", T.StringType())
    rows = docs.select(column_or_null(docs, "doc_id", T.LongType()).alias("doc_id"), *(F.coalesce(column_or_null(docs, c, T.StringType()), F.lit("none")).alias(c) for c in ("lang", "source")), F.coalesce(text, F.lit("")).alias("text"))
    return rows.select(
        "doc_id", (domain if domain is not None else domain_of()).alias("domain"), "lang", "source",
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"), F.md5(F.col("text").cast("binary")).alias("digest"),
    )


def _share_out(nodes: DataFrame, parents: list[str], level: str) -> DataFrame:
    """``budget`` of each node from ``given``, its parent's; nodes have ``capacity`` and ``weight``."""
    family = Window.partitionBy(*parents)
    order = family.orderBy((F.col("capacity") / F.col("weight")), level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.where("weight > 0 AND capacity > 0")
    left = F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    nodes = nodes.withColumn("own_level", left / rest)
    return nodes.withColumn("budget", F.least("capacity", F.col("weight") * F.max("own_level").over(family))).drop("own_level", "given")


def budgets(leaves: DataFrame, budget: float, weights: dict[str, dict[str, float]], max_epochs: int) -> DataFrame:
    """``budget`` in tokens of each of ``leaves`` (domain, lang, source, tokens)."""
    usable = leaves.where("tokens > 0")
    for level in LEVELS:
        usable = usable.where(_weight(level, weights) > 0)
    parents: list[str] = ["root"]
    usable = usable.withColumn("root", F.lit(0)).withColumn("capacity", F.col("tokens").cast("double") * max_epochs)
    given = usable.groupBy("root").agg(F.least(F.sum("capacity"), F.lit(float(budget))).alias("given"))
    for level in LEVELS:
        nodes = usable.groupBy(*parents, level).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(level, weights))
        shared = _share_out(nodes.join(given, parents), parents, level)
        parents = [*parents, level]
        given = shared.select(*parents, F.col("budget").alias("given"))
    return leaves.join(given.select(*LEVELS, F.floor(F.col("given") + 1e-6).alias("budget")), list(LEVELS))


def plan(rows: DataFrame, budget: float | None = None, share: float = SHARE, weights: dict | None = None, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """For each leaf: whole ``epochs``, and where the prefix of the next one ends (``end_slot``, ``end_key``).

    ``rows`` come from :func:`keyed`. The budget is ``share`` of all tokens unless given.
    """
    weights = WEIGHTS if weights is None else weights
    leaves = written(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs")), "leaves")
    if budget is None:
        budget = float(total_tokens(leaves)) * share
    leaf = budgets(leaves, budget, weights, max_epochs)
    leaf = leaf.select(*LEVELS, "tokens", "budget", F.expr("budget div tokens").alias("epochs"), F.expr("budget % tokens").alias("rest"), F.greatest(F.lit(1), F.expr(f"n_docs div {SLOT}")).alias("slots"))
    leaf = written(leaf, "budgets")
    placed = place(rows, leaf, seed)
    sums = placed.where("rest > 0").groupBy(*LEVELS, "slot").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    sums = written(sums.withColumn("group", F.expr(f"slot div {GROUP}")), "slots")
    running = lambda *order: Window.partitionBy(*LEVELS).orderBy(*order)
    # first the group of slots where the budget ends, then the slot, then the documents of that slot
    groups = sums.groupBy(*LEVELS, "group").agg(F.sum("n").alias("n"), F.first("rest").alias("rest")).withColumn("upto", F.sum("n").over(running("group").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    groups = groups.where("upto > rest AND upto - n <= rest").select(*LEVELS, "group", (F.col("upto") - F.col("n")).alias("before"))
    ends = sums.join(groups, [*LEVELS, "group"]).withColumn("upto", F.col("before") + F.sum("n").over(running("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = ends.where("upto > rest AND upto - n <= rest").select(*LEVELS, F.col("slot").alias("end_slot"), (F.col("rest") - F.col("upto") + F.col("n")).alias("room"))
    leaf = written(leaf.join(ends, list(LEVELS), "left").withColumn("end_slot", F.coalesce("end_slot", F.lit(-1))), "ends")
    # rows equal in id and text share a key and are one row here
    last = place(rows, leaf, seed, "end_slot", "room").where("slot = end_slot").groupBy(*LEVELS, "key", "room").agg(F.sum("n_tokens").alias("n"))
    keys = last.withColumn("upto", F.sum("n").over(running("key").rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("upto <= room").groupBy(*LEVELS).agg(F.max("key").alias("end_key"))
    return written(leaf.join(keys, list(LEVELS), "left").select(*LEVELS, "epochs", "rest", "slots", "end_slot", F.coalesce("end_key", F.lit(-1)).alias("end_key")), "plan")


def total_tokens(leaves: DataFrame) -> int:
    return leaves.agg(F.sum("tokens")).first()[0] or 0


def place(rows: DataFrame, leaf: DataFrame, seed: int, *more: str) -> DataFrame:
    """``rows`` of the leaves with their ``key`` in the epoch that is cut, and the slot it falls in."""
    leaf = leaf.select(*LEVELS, "epochs", "rest", "slots", *more)
    if leaf.count() <= BROADCAST_LEAVES:
        leaf = F.broadcast(leaf)  # else rows and leaves are shuffled, and AQE splits a hot leaf
    placed = rows.join(leaf, list(LEVELS)).withColumn("key", order_key(F.col("epochs"), seed))
    return placed.withColumn("slot", F.expr("(shiftright(key, 29) * slots) div 2147483648"))


def mixed(rows: DataFrame, leaf_plan: DataFrame, seed: int = SEED) -> DataFrame:
    """``rows`` once for each ``epoch`` that they are drawn in; ``rows`` have doc_id, the leaf and digest."""
    placed = place(rows, leaf_plan, seed, "end_slot", "end_key")
    drawn = F.expr("epochs + int(rest > 0 AND (slot < end_slot OR (slot = end_slot AND key <= end_key)))")
    out = placed.withColumn("copies", drawn).where("copies > 0").withColumn("epoch", F.explode(F.expr("sequence(0L, copies - 1L)")))
    return out.drop("epochs", "rest", "slots", "end_slot", "end_key", "key", "slot", "copies")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(keyed(spark.read.parquet(f"{sf_dir}/documents.parquet")), "keyed")
    return mixed(rows, plan(rows)).select("doc_id", *LEVELS, "epoch", "n_tokens")


def _oracle() -> str:
    def weight(level: str) -> str:
        cases = " ".join(f"WHEN {level} = '{n}' THEN {float(w)}" for n, w in WEIGHTS[level].items())
        return f"CASE {cases} ELSE 1.0 END" if cases else "1.0"

    levels, given = [], "SELECT 0 AS root, least(sum(capacity), {share} * sum(tokens)) AS given FROM leaves".format(share=SHARE)
    steps = [f"g0 AS ({given})"]
    parents = ["root"]
    for k, level in enumerate(LEVELS, 1):
        keys = ", ".join(parents)
        steps += [
            f"n{k} AS (SELECT {keys}, {level}, sum(capacity) AS capacity, {weight(level)} AS weight FROM leaves GROUP BY {keys}, {level})",
            f"l{k} AS (SELECT n.*, (given - coalesce(sum(capacity) OVER (PARTITION BY {keys} ORDER BY capacity / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))"
            f" / sum(weight) OVER (PARTITION BY {keys} ORDER BY capacity / weight, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM n{k} n JOIN g{k - 1} USING ({keys}))",
            f"g{k} AS (SELECT {keys}, {level}, least(capacity, weight * max(lvl) OVER (PARTITION BY {keys})) AS given FROM l{k})",
        ]
        parents.append(level)
    leaf = ", ".join(LEVELS)
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source, coalesce(text, '') AS text FROM documents),
rows_ AS (
  SELECT doc_id, coalesce('d' || CAST(TRY_CAST(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') AS INTEGER) % 3 AS VARCHAR), 'none') AS domain, lang, source,
    CAST(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens, md5(text) AS digest FROM docs),
leaves AS (
  SELECT 0 AS root, {leaf}, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) AS DOUBLE) * {MAX_EPOCHS} AS capacity FROM rows_ GROUP BY ALL HAVING sum(n_tokens) > 0),
{", ".join(steps)},
budget AS (SELECT {leaf}, tokens, CAST(floor(given + 1e-6) AS BIGINT) AS budget FROM g{len(LEVELS)} JOIN leaves USING ({leaf})),
placed AS (
  SELECT r.*, budget // tokens AS epochs, budget % tokens AS rest,
    CAST('0x' || substr(md5('{SEED}:' || CAST(budget // tokens AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || digest), 1, 15) AS BIGINT) AS key
  FROM rows_ r JOIN budget USING ({leaf})),
cut AS (
  SELECT *, epochs + CASE WHEN rest > 0 AND sum(n_tokens) OVER (PARTITION BY {leaf} ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= rest THEN 1 ELSE 0 END AS copies FROM placed)
SELECT doc_id, {leaf}, CAST(unnest(range(copies)) AS BIGINT) AS epoch, n_tokens FROM cut WHERE copies > 0"""


OP4_SQL = _oracle()
