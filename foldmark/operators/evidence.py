"""Signals about traits: which count at a day, what holds by then, and how predictions about them score.

Tables: ``signals`` (subject, trait, signal_id, session, day, ownership, valence, mode), ``traits`` (subject, trait,
kind, value), ``updates`` (subject, trait, day, seq, event, to_value) and ``days`` (subject, day): the day that is
asked about. Trait names restart with each subject, so every join is by both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["subject", "trait"]
#: rows that one task makes of a join with all market-wide events
TASK_ROWS = 10_000_000
#: subjects, or events, of one day in a list
LIST_ROWS = 1024
#: subjects that follow each other for every event: a multiple of 8 repeats to the byte in what is packed by bits
RUN = 256


def in_context(signals: DataFrame, sessions: DataFrame, days: DataFrame) -> DataFrame:
    """Signals of sessions that survived, up to the day asked about."""
    asked = days.select("subject", F.col("day").alias("asked"))
    return signals.join(sessions.select("session").distinct(), "session", "left_semi").join(asked, "subject").where("day <= asked").drop("asked")


def state_asof(traits: DataFrame, updates: DataFrame, days: DataFrame) -> DataFrame:
    """``traits`` with ``active`` (unless left dormant), ``held`` (the last update's value, else the own) and ``since``
    (day of the last update) as of the day asked about. An aggregate over the updates before it, no sort."""
    asked = days.select("subject", F.col("day").alias("asked"))
    past = updates.join(asked, "subject").where("day <= asked")
    when = F.struct("day", "seq")
    pick = lambda what, names: F.max_by(what, F.when(F.col("event").isin(*names), when))
    last = past.groupBy(*KEY).agg(
        pick("event", ("dormant", "revived")).alias("mood"), pick("to_value", ("update",)).alias("to_value"), F.max(F.when(F.col("event") == "update", F.col("day"))).alias("since")
    )
    found = traits.join(last, KEY, "left")
    return found.withColumns({"active": F.coalesce(F.col("mood") != "dormant", F.lit(True)), "held": F.coalesce("to_value", "value")}).drop("mood", "to_value")


def truth(subjects: DataFrame, params: DataFrame, state: DataFrame, *also: str) -> DataFrame:
    """``subject, trait, kind, truth_active, truth_value`` of every candidate in ``params`` (trait, kind), held or not;
    ``also``: columns of the state to keep."""
    every = subjects.select("subject").distinct().crossJoin(F.broadcast(params))  # params are a stated list
    found = every.join(state.select(*KEY, "active", "held", *also), KEY, "left")
    bias = F.col("kind") == "bias"
    return found.select("subject", "trait", "kind", F.when(bias, F.coalesce("active", F.lit(False))).alias("truth_active"), F.when(~bias, F.col("held")).alias("truth_value"), *also)


def supporting(signals: DataFrame, state: DataFrame) -> DataFrame:
    """Own confirming signals of each trait; of a preference those since its last update."""
    own = signals.where("ownership = 'self' AND valence = 'confirm'").join(state.select(*KEY, "kind", "since"), KEY)
    return own.where("kind = 'bias' OR since IS NULL OR day >= since").drop("kind", "since")


def before_update(signals: DataFrame, traits: DataFrame, updates: DataFrame) -> DataFrame:
    """Signals of preferences from strictly before the first update of their trait."""
    first = updates.where("event = 'update'").groupBy(*KEY).agg(F.min("day").alias("first"))
    held = traits.where("kind = 'preference'").select(*KEY)
    return signals.join(held, KEY, "left_semi").join(first, KEY).where("day < first").drop("first")


def listed(rows: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """Distinct values of ``column`` for each of ``keys``, in order, as one text; bounded by what one subject has."""
    return rows.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_set(column)), ",").alias(name))


def right() -> Column:
    """Whether a prediction says what the truth says; none says that nothing is held."""
    return F.when(F.col("kind") == "bias", F.col("predicted_active").eqNullSafe(F.col("truth_active"))).otherwise(F.col("predicted_value").eqNullSafe(F.col("truth_value")))


def cited_rows(predictions: DataFrame, truths: DataFrame, signals: DataFrame, sessions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Predictions (subject, trait, predicted_active, predicted_value, cited) scored against ``truths``, and warnings.

    Cited sessions that do not exist are dropped and warned of. A cited session that holds a retracted or foreign signal
    of that trait is falsely attributed.
    """
    each = predictions.select(*KEY, F.explode("cited").alias("session")).distinct()
    known = sessions.select("subject", "session").distinct()
    good, unknown = each.join(known, ["subject", "session"], "left_semi"), each.join(known, ["subject", "session"], "left_anti")
    wrong = signals.where("valence = 'retracted' OR ownership <> 'self'").select(*KEY, "session").distinct().withColumn("false", F.col("session"))
    lists = good.join(wrong, [*KEY, "session"], "left").groupBy(*KEY)
    text = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    lists = lists.agg(text("session").alias("cited"), text("false").alias("falsely"))
    rows = truths.join(predictions.drop("cited"), KEY, "left").join(lists, KEY, "left")
    rows = rows.withColumns({"correct": right(), "cited": F.coalesce("cited", F.lit("")), "falsely": F.coalesce("falsely", F.lit(""))})
    return rows, unknown


def recovered(signals: DataFrame, sessions: DataFrame, rows: DataFrame, classes: DataFrame, early: DataFrame) -> DataFrame:
    """Each signal of a surviving session beside its trait's scored row and, if it was classified, its class."""
    kept = signals.join(sessions.select("session").distinct(), "session", "left_semi").join(rows.select(*KEY, "kind", "correct", F.col("cited").alias("list")), KEY)
    cited = F.array_contains(F.split("list", ","), F.col("session").cast("string"))
    found = kept.withColumn("cited", cited).join(classes, "signal_id", "left").join(early.select("signal_id", F.lit(True).alias("early")), "signal_id", "left")
    return found.select(
        "signal_id", *KEY, "session", "kind", F.coalesce("early", F.lit(False)).alias("pre_update"), "cited", (F.col("cited") & F.col("correct")).alias("recovered"),
        F.col("predicted_kind").isNotNull().alias("classified"), "predicted_kind", (F.col("predicted_kind") == F.col("kind")).alias("kind_ok"),
    )


def calendar_window(asked: DataFrame, events: DataFrame, axis: DataFrame, back: int, forward: int, iso: bool = False) -> DataFrame:
    """Own and market-wide ``events`` (day, subject or null, event, surprise) from ``back`` trading days before to
    ``forward`` after the day asked about (subject, day), which always counts; what is yet to come shows no surprise.

    ``axis`` (day) are the trading days, a calendar of bounded length. Each day asked about becomes the few days of
    its window, so the join is by day: no range is compared. Every subject gets all market-wide events of its window, so
    the rows are as many as both multiplied. Subjects that ask about one day, and events of one day, meet in lists, and
    rows are made of two lists where they are read: event by event, with the same subjects for each, which is written
    in a small part of the room that events by subject take. All that can be is done to a day or an event before that,
    days as text (``iso``), too.
    """
    days = axis.agg(F.sort_array(F.collect_set("day")).alias("days"))
    at = asked.select("subject", F.col("day").alias("today"))
    place = lambda t: f"get(days, int(greatest(0, least({t}, size(days) - 1))))"
    low, high = place(f"t - {back}"), place(f"t + {forward} - if(array_contains(days, today), 0, 1)")
    shown = lambda c: F.col(c).cast("string" if iso else "date")
    own, market = events.where("subject IS NOT NULL").withColumnRenamed("day", "__day"), events.where("subject IS NULL").drop("subject").withColumnRenamed("day", "__day")
    tasks = max(asked.sparkSession.sparkContext.defaultParallelism, asked.count() * market.count() * (back + forward + 1) // max(axis.count(), 1) // TASK_ROWS + 1)

    def window(rows: DataFrame, *also: str) -> DataFrame:
        found = rows.crossJoin(F.broadcast(days)).withColumn("t", F.expr("size(filter(days, x -> x < today))"))
        days_of = found.select(*also, "today", F.explode(F.expr(f"sequence(least({low}, today), greatest({high}, today))")).alias("__day"))
        return days_of.select(*also, shown("today").alias("today"), shown("__day").alias("day"), "__day", (F.col("__day") <= F.col("today")).alias("__past"))

    seen = lambda rows: rows.withColumn("surprise", F.when(F.col("__past"), F.col("surprise"))).drop("__past")
    mine = seen(window(at, "subject").join(own, ["subject", "__day"])).drop("__day").withColumn("scope", F.lit("own"))
    told = [c for c in market.columns if c != "__day"]
    asking = window(listed_by(at, "today", ["subject"], "__subjects").withColumn("__subjects", F.col("__subjects.subject")), "__part", "__subjects")
    known = listed_by(market, "__day", told, "__events").withColumnRenamed("__part", "__block")
    met = asking.join(known, "__day").repartition(tasks, "today", "__part", "__day", "__block")
    runs = F.expr(f"transform(sequence(1, size(__subjects), {RUN}), i -> slice(__subjects, i, {RUN}))")
    wide = met.select("today", "day", "__past", "__events", F.explode(runs).alias("__run")).select("today", "day", "__past", "__run", F.inline("__events"))
    return mine.unionByName(seen(wide).select(F.explode("__run").alias("subject"), "today", "day", *told, F.lit("market").alias("scope")))


def listed_by(rows: DataFrame, day: str, columns: list[str], name: str) -> DataFrame:
    """``columns`` of the rows of each ``day`` in lists ``name`` of about ``LIST_ROWS`` each, with their number ``__part``."""
    parts = rows.groupBy(day).agg(F.ceil(F.count("*") / LIST_ROWS).alias("__parts")).withColumnRenamed(day, "__of")
    dealt = rows.join(F.broadcast(parts), F.col(day).eqNullSafe(F.col("__of")))  # a row for each day of a calendar
    return dealt.groupBy(day, F.pmod(F.xxhash64(*columns), "__parts").alias("__part")).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))


def cogrouped(tables: dict[str, DataFrame], by: str, figures: list[Column]) -> DataFrame:
    """One row for each ``by`` of any of the ``tables``, with each table's ``figures`` over its rows under the table's name."""
    out = None
    for name, rows in tables.items():
        one = rows.groupBy(by).agg(F.struct(*figures).alias(name))
        out = one if out is None else out.join(one, by, "full")
    return out


def twins(open_rows: DataFrame, closed: DataFrame, keys: list[str], id_: str) -> DataFrame:
    """``open_rows`` with the one row of ``closed`` of equal ``keys``: ``twin``, null unless there is exactly one, and ``n_twins``."""
    one = closed.groupBy(*keys).agg(F.count("*").alias("n_twins"), F.min(id_).alias("twin"))
    return open_rows.join(one, keys, "left").withColumns({"n_twins": F.coalesce("n_twins", F.lit(0)), "twin": F.when(F.col("n_twins") == 1, F.col("twin"))})


def merged(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of both; one of a ``key`` that both have must be equal in them, or the merge fails where it is read."""
    every = a.unionByName(b).distinct()
    check = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit(f"unequal rows of {key} "), F.col(key).cast("string")))).otherwise(F.lit(False))
    names = [c for c in a.columns if c != key]
    return every.groupBy(key).agg(F.count("*").alias("n"), F.first(F.struct(*names)).alias("r")).where(~check).select(key, "r.*").select(*a.columns)


def coverage(actual: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Keys that are missing from ``actual`` or should not be there; none where the two are equal."""
    a, b = actual.select(key).distinct(), expected.select(key).distinct()
    return b.join(a, key, "left_anti").withColumn("side", F.lit("missing")).unionByName(a.join(b, key, "left_anti").withColumn("side", F.lit("extra")))


def redistributed(shares: Column, counts: Column) -> Column:
    """Shares, capped at the counts; what is left over goes round in order, one at a time, to whoever has room.

    After ``r`` whole rounds a part with room ``x`` has got ``least(x, r)``: the number of rounds is looked up, then
    the rest of one round is handed on.
    """
    zipped = F.transform(F.arrays_zip(shares.alias("s"), counts.alias("c")), lambda p: F.struct(F.least(p["s"], p["c"]).alias("own"), (p["c"] - F.least(p["s"], p["c"])).alias("room")))
    total = lambda values: F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)
    given = lambda parts, r: total(F.transform(parts, lambda p: F.least(p["room"], r)))
    spare = total(shares) - total(F.transform(zipped, lambda p: p["own"]))
    # bound to a name, so that nothing is computed again for each part
    state = F.transform(F.array(F.struct(zipped.alias("parts"), spare.alias("spare"))), lambda s: F.struct(
        s["parts"].alias("parts"), s["spare"].alias("spare"),
        F.array_max(F.filter(F.sequence(F.lit(0).cast("long"), s["spare"]), lambda r: given(s["parts"], r) <= s["spare"])).alias("rounds")))
    state = F.transform(state, lambda s: F.struct(s["parts"].alias("parts"), s["rounds"].alias("rounds"), (s["spare"] - given(s["parts"], s["rounds"])).alias("rest")))
    place = lambda s, i: F.size(F.filter(F.slice(s["parts"], F.lit(1), i), lambda q: q["room"] > s["rounds"]))
    return F.get(F.transform(state, lambda s: F.transform(s["parts"], lambda p, i: p["own"] + F.least(p["room"], s["rounds"]) + F.when((p["room"] > s["rounds"]) & (place(s, i) < s["rest"]), 1).otherwise(0))), F.lit(0))
