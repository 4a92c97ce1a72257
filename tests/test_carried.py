"""Operators that carry something over slices of a key, against folds over the whole key."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from foldmark.operators import asof, intervals, recurrence


@pytest.fixture(scope="module")
def days():
    """One key with a third of all rows, keys with one row, gaps from a day to years."""
    rng = random.Random(3)
    out = []
    for key, n in (("hot", 400), ("a", 150), ("b", 120), ("one", 1), *((f"k{k}", 10) for k in range(40))):
        day = date(2020, 1, 1)
        for _ in range(n):
            day += timedelta(days=rng.choice([1, 1, 2, 5, 40, 900 if rng.random() < 0.05 else 1]))
            out.append((key, day, rng.uniform(-5, 5)))
    return out


@pytest.mark.parametrize("half_life", [0.02, 3.0, 500.0])
def test_event_ema_is_the_fold(spark, days, half_life):
    want = {}
    for key, day, v in days:
        last = want.get(key)
        e = v if last is None else last[1] + (1 - 2 ** (-(day - last[0]).days / half_life)) * (v - last[1])
        want[key] = (day, e)
        want[key, day] = e
    for unit in ("WEEK", "YEAR"):
        found = recurrence.event_ema(spark.createDataFrame(days, "k string, d date, v double"), "k", "d", "v", half_life, unit)
        rows = found.collect()
        assert len(rows) == len(days) and found.columns == ["k", "d", "v", "ema"]
        for r in rows:
            assert r.ema == pytest.approx(want[r.k, r.d], abs=1e-9, rel=1e-9)


def test_street_scores_and_positioning_are_the_folds(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for key, n in (("hot", 700), ("a", 300), ("b", 90), ("flipped at once", 30), ("none", 20)):
        score, at, pct, told = 0.0, 0, 50.0, 0
        for t in range(n):
            trend, upd, flip, rep = rng.uniform(-1, 1), rng.random() < 0.3, rng.random() < 0.06 or key == "flipped at once" and t == 0, rng.random() < 0.2
            if key == "none":
                upd = flip = rep = False
            rows.append((key, t, trend, upd, flip, rep))
            if flip:
                score, at = (-1.0 if score >= 0 else 1.0) * 2 * 0.15, t
            elif upd:
                score, at = score + (1 - 2 ** (-(t - at) / 5)) * (trend - score), t
            if rep:
                pct, told = pct + (1 - 2 ** (-(t - told) / 15)) * (50 + 40 * math.tanh(2 * trend) - pct), t
            want[key, t] = score, pct
    df = spark.createDataFrame(rows, "k string, t long, trend double, upd boolean, flip boolean, rep boolean")
    for width in (7, 64, 10_000):
        found = recurrence.positioning(recurrence.street_scores(df, "k", "t", "trend", "upd", "flip", 5.0, 0.15, width), "k", "t", "trend", "rep", 15.0, width).collect()
        assert len(found) == len(rows)
        for r in found:
            assert (r.street_score, r.positioning_pct) == pytest.approx(want[r.k, r.t], abs=1e-9)


@pytest.mark.parametrize("relative", [0.0, 0.01, 0.5, 0.99])
def test_confirmation_by_any_number_is_that_of_all_pairs(spark, relative):
    rng = random.Random(int(relative * 100))
    number = lambda: rng.choice([0.0, 1e-9, -1e-9, 3e-9, 1e300, 5.0, -5.0, rng.uniform(-10, 10), rng.uniform(-10, 10) ** 9, rng.uniform(0.9, 1.1)])
    left = [(k, rng.choice(["hot", "a", None]), number()) for k in range(400)] + [(900, "a", None), (901, "b", 1.0)]
    right = [(rng.choice(["hot", "a", None]), number()) for _ in range(60)] + [("a", None)]
    found = asof.confirmed_by_any(spark.createDataFrame(left, "id int, k string, v double"), spark.createDataFrame(right, "k string, v double"), ["k"], "v", relative)
    for r in found.collect():
        want = r.v is not None and any(k is not None and k == r.k and x is not None and abs(r.v - x) <= relative * max(abs(x), 1e-9) for k, x in right)
        assert r.confirmed == want, r
    assert found.count() == len(left) and found.columns == ["id", "k", "v", "confirmed"]


def test_confirmation_by_the_market_knows_units_and_days(spark):
    d = lambda n: date(2024, 3, n)
    quotes = spark.createDataFrame([("x", d(1), "percent", 5.0), ("x", d(9), "bp", 700.0), ("y", d(2), None, 5.0), ("z", d(1), "one", 1.0), ("z", d(2), "one", None)], "k string, day date, unit string, value double")
    said = [(1, "x", d(1), "bp", 500.0), (2, "x", d(8), "one", 0.0504), (3, "x", d(9), "percent", 7.05), (4, "x", d(9), "percent", 5.0), (5, "x", date(2024, 2, 1), "bp", 500.0), (6, "y", d(3), "one", 5.0), (7, "x", d(9), "lots", 7.0), (8, "z", d(3), "one", 1.0), (9, None, d(3), "one", 1.0)]
    found = asof.confirmed_by_market(spark.createDataFrame(said, "id int, k string, day date, unit string, value double"), quotes, ["k"], {"one": 1.0, "percent": 0.01, "bp": 0.0001}, 0.01)
    assert {r.id for r in found.collect() if r.confirmed} == {1, 2, 3} and found.count() == len(said)


def test_days_in_half_open_intervals(spark):
    rng = random.Random(4)
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    spans = []
    for _ in range(120):
        first = rng.randint(0, 300)
        spans.append((rng.choice(["hot", "a", "b", None]), day(first), rng.choice([None, day(first + rng.randint(-2, 9))]) if rng.random() < 0.05 else day(first + rng.randint(0, 9))))
    spans += [("whole", date(1990, 1, 1), None), ("whole", day(5), day(6)), ("never", None, day(3))]
    points = [(k, rng.choice(["hot", "a", "b", "whole", "never", None]), day(rng.randint(0, 330))) for k in range(500)] + [(900, "a", None)]
    df, by = spark.createDataFrame(points, "id int, k string, d date"), spark.createDataFrame(spans, "k string, s date, e date")
    for unit in ("DAY", "MONTH", "YEAR"):
        for r in intervals.covered(df, by, ["k"], "d", "s", "e", "yes", unit).collect():
            want = r.d is not None and any(k is not None and k == r.k and s is not None and s <= r.d and (e is None or r.d < e) for k, s, e in spans)
            assert r.yes == want, r


def test_slices_of_numbers_are_in_their_order(spark):
    xs = sorted([0.0, 5e-324, -5e-324, 1e-300, 1.0, -1.0, 1.0001, 2.0, -2.0, 1e308, -1e308])
    found = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(asof.number_slice(F.col("x"))).collect()]
    assert found == sorted(found)


def test_maps_compose_from_any_start(spark):
    t0 = datetime(2024, 1, 1)
    rows = [("a", k, t0 + timedelta(hours=7 * k), 0.5 if k % 3 else 0.0 if k == 9 else 1.0, float(k)) for k in range(40)]
    df = spark.createDataFrame(rows, "k string, i int, t timestamp, a double, b double").withColumn("slice", F.date_trunc("DAY", "t"))
    for r in recurrence.composed(df, ["k"], "i", "slice", F.col("a"), F.col("b")).collect():
        for start in (0.0, 3.0):
            e = start
            for _, i, _, a, b in rows:
                e = a * e + b if i <= r.i else e
            assert r.factor * start + r.offset == pytest.approx(e, rel=1e-12)


def test_maps_of_many_keys_stream_by(spark):
    """No function is called for each key, and a key may lie in several batches."""
    from pyspark.sql import functions as F

    from foldmark.operators import recurrence

    own = [(k, d, float((k * 7 + d) % 5)) for k in range(40) for d in range(0, 400, 1 + k * 3)]
    df = spark.createDataFrame(own, "k long, d int, v double").withColumn("day", F.expr("date_add(date'2024-01-01', d)"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        out = recurrence.event_ema(df, "k", "day", "v", 5.0)
        assert "FlatMapGroups" not in out._jdf.queryExecution().optimizedPlan().toString()
        found = {(r.k, r.d): r.ema for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    last, want = {}, {}
    for k, d, v in own:
        at, e = last.get(k, (d, v))
        e += (1 - 2.0 ** (-(d - at) / 5.0)) * (v - e)
        last[k], want[k, d] = (d, e), e
    assert found.keys() == want.keys() and all(abs(found[x] - want[x]) < 1e-9 for x in want)
