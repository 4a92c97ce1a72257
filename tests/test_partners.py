import random
from datetime import date

from foldmark.plans.contexts import least_other, nearest_in_value
from foldmark.sources import tables


def test_partners_against_all_pairs(spark):
    rng = random.Random(6)
    rows = [(k, rng.choice(["x", "y", None]), rng.choice([None, *range(6)]), rng.random() < 0.3, "n") for k in range(80)] + [(900, "alone", 1, False, "n")]
    df = spark.createDataFrame(rows, "id int, two string, a int, held boolean, other string")
    near = {r.id: r.partner for r in nearest_in_value(df, "two", "a", "id").collect()}
    free = {r.id: r.partner for r in least_other(df, "two", "a", "id", "held").collect()}
    assert len(near) == len(free) == len(rows)
    for k, by, v, _, _ in rows:
        own = [r for r in rows if r[1] == by and r[0] != k and r[2] is not None] if by is not None else []
        if by is not None:
            assert near[k] == (min(own, key=lambda r: (abs(r[2] - v), r[0]))[0] if own and v is not None else None)
        own = [r for r in own if not r[3]]
        assert free[k] == (min(own, key=lambda r: (r[2], r[0]))[0] if own else None)


def test_two_rows_of_one_day_are_one_value(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 1), 1.0), ("a", date(2024, 1, 1), 3.0), ("a", date(2024, 1, 3), 2.0), ("a", None, 9.0)], "k string, d date, v double")
    assert tables.day_arrays(df, "k", "d", "v").first()["values"] == [3.0, None, 2.0]
