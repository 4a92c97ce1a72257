"""Hidden columns, bounds in time and JSON, before and after plans run."""

import json as plain
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from foldmark.functions import json
from foldmark.operators import views
from foldmark.operators.views import AsOf, Leak, Unbounded


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, "a", 5.0, ["x"]), (2, "b", 6.0, [])], "id int, name string, secret double, tags array<string>")


def test_what_derives_from_a_hidden_column_is_found(spark, df):
    w = Window.partitionBy("name").orderBy("id")
    other = df.select("id", "name")
    leaks = {
        "renamed": df.select("id", F.col("secret").alias("fine")),
        "expression": df.select((F.col("secret") * 0 + F.col("id")).alias("fine")),
        "aggregate": df.groupBy("name").agg(F.max("secret").alias("fine")),
        "grouped": df.groupBy((F.col("secret") > 1).alias("fine")).count(),
        "window": df.select("id", F.sum("secret").over(w).alias("fine")),
        "nested": df.select(F.struct("id", F.struct("secret").alias("s")).alias("fine")),
        "generated": df.select("id", F.explode(F.array("secret")).alias("fine")),
        "union": other.select("id", F.lit(1.0).alias("fine")).union(df.select("id", "secret")),
        "self join": other.join(df.select("id", F.col("secret").alias("fine")), "id").join(df.select("id", "name").withColumnRenamed("name", "n2"), "id").select("fine"),
        "twice": df.alias("a").join(df.alias("b"), F.col("a.id") == F.col("b.id")).select(F.col("b.secret").alias("fine")),
        "distinct": df.select(F.col("secret").alias("fine")).distinct(),
        "case": df.select(F.when(F.col("secret") > 5, "high").otherwise("low").alias("fine")),
        "higher order": df.select(F.transform("tags", lambda t: F.concat(t, F.col("secret").cast("string"))).alias("fine")),
    }
    df.createOrReplaceTempView("seen")
    leaks["subquery"] = spark.sql("SELECT id, (SELECT max(secret) FROM seen) AS fine FROM seen")
    for name, bad in leaks.items():
        assert "fine" in views.hidden_outputs(bad, {"secret"}), name
        with pytest.raises(Leak, match="fine"):
            views.shown(bad, {"secret"})
    fine = [
        df.drop("secret"), df.where("secret > 5").select("id", "name"), df.orderBy("secret").select("id"), df.groupBy("name").agg(F.count("*").alias("n")),
        df.select("id", F.explode("tags").alias("t")), df.alias("a").join(df.alias("b"), "id").select("a.name", F.lit("secret").alias("x")), other.union(other), spark.sql("SELECT (SELECT max(id) FROM seen) AS m, name FROM seen"),
    ]
    for k, good in enumerate(fine):
        assert views.hidden_outputs(good, {"secret"}) == [], k


def test_views_are_nested_by_subject_and_checked(spark, df):
    subjects = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "pm int, name string")
    sessions = spark.createDataFrame([(1, 2, "late"), (1, 1, "early"), (2, 5, None), (9, 1, "nobody")], "pm int, day int, said string")
    found = {r.pm: [tuple(s) for s in r.sessions] for r in views.assembled(subjects, {"sessions": (sessions, ["day"])}, "pm", {"secret"}).collect()}
    assert found == {1: [(1, "early"), (2, "late")], 2: [(5, None)], 3: []}
    some = views.assembled(subjects, {"sessions": (sessions, ["day"])}, "pm", set(), spark.createDataFrame([(1,), (1,)], "pm int"))
    assert [r.pm for r in some.collect()] == [1]
    with pytest.raises(KeyError, match="9"):
        views.assembled(subjects, {}, "pm", set(), sessions)
    with pytest.raises(Leak):
        views.assembled(subjects, {"s": (sessions.withColumn("x", F.length("said")), ["day"])}, "pm", {"said"})


def test_nothing_after_the_day_is_read(spark, tmp_path):
    spark.sql("SELECT id, timestamp'2024-01-10 00:00:00' + make_interval(0, 0, 0, 0, CAST(id AS INT) * 6) AS ts FROM range(40)").write.parquet(f"{tmp_path}/e")
    e, names = spark.read.parquet(f"{tmp_path}/e"), spark.createDataFrame([(1, "a")], "id long, name string")
    known = AsOf("2024-01-12", {"e": (e, "ts")}, {"names": names})
    rows = known.checked(known.read("e").join(known.read("names"), "id", "left"))
    assert max(r.ts for r in rows.collect()).isoformat() == "2024-01-12T18:00:00" and rows.count() == 12
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts," in rows._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Unbounded, match="without its bound"):
        known.checked(known.read("e").join(e.select("id"), "id"))
    e.createOrReplaceTempView("raw")
    known.read("names").createOrReplaceTempView("told")
    with pytest.raises(Unbounded, match="without its bound"):
        known.checked(spark.sql("SELECT id, (SELECT max(ts) FROM raw) AS t FROM told"))
    with pytest.raises(Unbounded, match="no date"):
        known.read("other")
    with pytest.raises(Unbounded, match="no column day"):
        AsOf("2024-01-12", {"e": (e, "day")})


def test_json_is_sorted_and_compact_at_every_depth(spark):
    rng = random.Random(1)
    rows = [(k, (rng.choice([None, "é\"\\/\n"]), {rng.choice("zyxab") + str(j): (j, None) for j in range(rng.randint(0, 4))}, [{"b": [1, k], "a": {}}, None], None)) for k in range(20)]
    schema = "id int, r struct<z: string, m: map<string, struct<y: int, x: string>>, l: array<map<string, array<int>>>, a: struct<q: int>>"
    rows = [(k, (z, m, [{"b": [1, k], "a": []}, None], a)) for k, (z, m, _, a) in rows]
    df = spark.createDataFrame(rows, schema)
    for r in df.select("id", json.canonical(F.col("r"), df.schema["r"].dataType).alias("j")).collect():
        _, (z, m, items, a) = rows[r.id]
        want = {"z": z, "m": {k: {"y": y, "x": x} for k, (y, x) in m.items()}, "l": items, "a": a}
        assert r.j == plain.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_the_last_block_by_depth(spark):
    cases = [
        ('a {"x": {"y": {"z": {"w": {}}}}} b', '{"x": {"y": {"z": {"w": {}}}}}'), ('{"a": 1} {"b": 2}', '{"b": 2}'), ('{ open {"a": "}"} it\'s', '{"a": "}"}'), ('{"a": "\\"}{"}', '{"a": "\\"}{"}'),
        ("none", None), ("} {", None), ("", None), (None, None), ('{"a": {"b": 1}', '{"b": 1}'),
    ]
    found = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(cases)], "k int, t string").select("k", json.last_block(F.col("t")).alias("b")).collect()
    assert {r.k: r.b for r in found} == {k: b for k, (_, b) in enumerate(cases)}
