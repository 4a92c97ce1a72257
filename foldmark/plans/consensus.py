"""Street consensus: trend, an average with flips, positioning, and their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.operators import recurrence, windows
from foldmark.plans.registry import DAILY_SQL, daily, query, rounded

# windows of 5 and 15 days, threshold 0.15, positioning beyond 35 and 65; revisions on Mondays, reports on Fridays; an
# event series is busy, which is an update as well, where it has more rows than on the day before, and flips on every eleventh day
_WINDOW, _WIDE, _THRESHOLD, _VOL, _FLIP = 5, 15, 0.15, 4.0, "t % 11 = 7"
_TREND_SQL = "greatest(-1, least(1, (s - coalesce(lag(s, {w}) OVER o, first_value(s) OVER o)) / ({v} * sqrt({w} / 252.0))))"


@query(f"""
WITH RECURSIVE {DAILY_SQL}, sig AS (SELECT event_type, day, t, n, ln(level) AS s FROM indexed),
x AS (SELECT event_type, day, t, {_TREND_SQL.format(w=_WINDOW, v=_VOL)} AS street, {_TREND_SQL.format(w=_WIDE, v=_VOL)} AS wide, {_FLIP} AS flip, isodow(day) = 1 OR coalesce(n > lag(n) OVER o, false) AS upd, isodow(day) = 5 AS rep
  FROM sig WINDOW o AS (PARTITION BY event_type ORDER BY t)),
e(event_type, t, score, moved, pct, told) AS (SELECT DISTINCT event_type, CAST(-1 AS BIGINT), 0.0::DOUBLE, CAST(0 AS BIGINT), 50.0::DOUBLE, CAST(0 AS BIGINT) FROM x
  UNION ALL SELECT x.event_type, x.t, CASE WHEN flip THEN CASE WHEN score >= 0 THEN -{2 * _THRESHOLD} ELSE {2 * _THRESHOLD} END WHEN upd THEN score + (1 - pow(2.0, -(x.t - moved) / {_WINDOW}.0)) * (street - score) ELSE score END,
    CASE WHEN flip OR upd THEN x.t ELSE moved END, CASE WHEN rep THEN pct + (1 - pow(2.0, -(x.t - told) / {_WIDE}.0)) * (50 + 40 * tanh(2 * wide) - pct) ELSE pct END, CASE WHEN rep THEN x.t ELSE told END FROM e JOIN x ON x.event_type = e.event_type AND x.t = e.t + 1)
SELECT e.event_type, day, round(score, 6) AS street_score, round(pct, 6) AS positioning_pct, CASE WHEN score > {_THRESHOLD} THEN 'overweight' WHEN score < -{_THRESHOLD} THEN 'underweight' ELSE 'neutral' END AS view,
  CASE WHEN pct > 65 THEN 'crowded long' WHEN pct < 35 THEN 'crowded short' ELSE 'neutral' END AS positioning FROM e JOIN x ON x.event_type = e.event_type AND x.t = e.t""", dates=("day",))
def consensus_build(spark: SparkSession, d: str) -> DataFrame:
    """Score, positioning and labels on every day of each series."""
    from pyspark.sql import Window

    order = Window.partitionBy("event_type").orderBy("t")
    x = daily(spark, d).withColumn("s", F.log("level"))
    trend = lambda w: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), windows.trailing_move("s", "event_type", w) / (_VOL * (w / 252.0) ** 0.5)))
    x = x.withColumns({"street": trend(_WINDOW), "wide": trend(_WIDE), "flip": F.expr(_FLIP), "rep": F.dayofweek("day") == 6})
    x = x.withColumn("upd", (F.dayofweek("day") == 2) | F.coalesce(F.col("n") > F.lag("n").over(order), F.lit(False)))
    x = recurrence.street_scores(x, "event_type", "t", "street", "upd", "flip", float(_WINDOW), _THRESHOLD)
    x = recurrence.positioning(x, "event_type", "t", "wide", "rep", float(_WIDE))
    view, crowd = recurrence.street_view(F.col("street_score"), _THRESHOLD), recurrence.crowding(F.col("positioning_pct"), 35, 65)
    return rounded(x.select("event_type", "day", "street_score", "positioning_pct", view.alias("view"), crowd.alias("positioning")), "street_score", "positioning_pct")


@query("""
WITH RECURSIVE v AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS value FROM events GROUP BY 1, 2), i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS k FROM v),
e AS (SELECT user_id, k, day, value AS ema FROM i WHERE k = 1 UNION ALL SELECT i.user_id, i.k, i.day, e.ema + (1 - pow(2.0, -(i.day - e.day) / 5.0)) * (i.value - e.ema) FROM e JOIN i ON i.user_id = e.user_id AND i.k = e.k + 1)
SELECT user_id, day, round(ema, 6) AS ema FROM e""", dates=("day",))
def event_emas(spark: SparkSession, d: str) -> DataFrame:
    """The event-driven average of each subject after each of its days."""
    from foldmark.plans.registry import table

    v = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sum("value").alias("value"))
    return rounded(recurrence.event_ema(v, "user_id", "day", "value", 5.0).select("user_id", "day", "ema"), "ema")
