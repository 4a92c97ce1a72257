import random
from datetime import date, timedelta

from foldmark.operators import audits


def test_spacing_against_a_loop(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), date(2024, 1, 1) + timedelta(days=rng.randint(0, 300))) for _ in range(60)] + [("one", date(2024, 5, 5)), ("one", date(2024, 5, 5)), ("a", None)]
    subjects = spark.createDataFrame([(k,) for k in ("a", "b", "one", "none")], "k string")
    for r in audits.spacing_metrics(spark.createDataFrame(rows, "k string, d date"), subjects, "k", "d", 104).collect():
        days = sorted({d for k, d in rows if k == r.k and d})
        gaps = [(b - a).days for a, b in zip(days, days[1:])]
        assert (r.n, r.least, r.covered, r.smallest_gap, r.largest_gap) == (len(days), 6, len(days) >= 6, min(gaps, default=None), max(gaps, default=None))


def test_faults_of_a_map(spark):
    catalogue = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "a")], "param string, value string")
    entries = spark.createDataFrame([("p", "a", "table"), ("p", "c", "table"), ("r", "a", None)], "param string, value string, kind string")
    assert {tuple(r) for r in audits.map_faults(catalogue, entries, ["table"]).collect()} == {
        ("q", None, "no entry for the parameter"), ("p", "b", "no entry for the value"), ("p", "c", "not in the catalogue"), ("r", "a", "not in the catalogue"), ("r", "a", "unknown kind: none")
    }


def test_counts_kind_by_kind(spark):
    rows = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "e string")
    drawn = spark.createDataFrame([("x", 2), ("z", 0), ("w", 1)], "e string, n long")
    assert {tuple(r) for r in audits.count_metrics(rows, drawn, "e").collect()} == {("x", 2, 2, True), ("y", 0, 1, False), ("z", 0, 0, True), ("w", 1, 0, False)}
