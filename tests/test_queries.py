import math

import duckdb
import pytest

from foldmark.plans import catalogue

FOLDER = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    return v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in catalogue.ORACLE_SQL:
        assert got
        return
    found = duck.execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({catalogue.ORACLE_SQL[name]})").fetchall()
    assert got == sorted((tuple(plain(v) for v in r) for r in found), key=repr)


def test_weekly_stream(spark, tmp_path):
    from foldmark.streaming import windows

    spark.read.parquet(f"{FOLDER}/events.parquet").withColumn("ts", catalogue_ts()).repartition(3).write.parquet(f"{tmp_path}/in")
    query = windows.weekly(windows.read_events(spark, f"{tmp_path}/in")).writeStream.outputMode("complete").format("memory").queryName("weekly").start()
    query.processAllAvailable()
    query.stop()
    assert spark.sql("SELECT sum(n) FROM weekly").first()[0] == spark.read.parquet(f"{FOLDER}/events.parquet").count()


def catalogue_ts():
    from pyspark.sql import functions as F

    return F.col("ts").cast("timestamp")


def test_market_paths_run_over_52_weeks(spark):
    from pyspark.sql import functions as F

    paths = catalogue.QUERIES["market_paths"](spark, "/root/testdata/sf0.001").groupBy("p_partkey").agg(F.count("*").alias("n"), F.min("day").alias("a"), F.max("day").alias("b"))
    assert {(r.n, r.a, r.b) for r in paths.collect()} == {(260, "2024-01-01", "2024-12-27")}


def test_market_paths_draw_once_and_shuffle_no_path(spark):
    """Each draw stands in the plan once, the paths lie where their parts were dealt to, and they are those of the keyed normals."""
    import hashlib
    from statistics import NormalDist

    df = catalogue.QUERIES["market_paths"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("sha2(") <= 2
    physical = plan.sparkPlan().toString() + plan.executedPlan().toString()
    assert "Exchange" not in physical[physical.index("AdaptiveSparkPlan") :].split("Generate")[0]
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet").where("p_partkey = 7").first()
    normal = lambda *on: NormalDist().inv_cdf(int(hashlib.sha256("|".join(map(str, on)).encode()).hexdigest()[:13], 16) / 2**52)
    total = 0.0
    for r in df.where("p_partkey = 7").orderBy("t").collect():
        total += 0.01 * (0.6 * normal("factor", r.t) + 0.8 * normal("own", 7, r.t))
        assert r.price == pytest.approx(part.p_retailprice * math.exp(total), abs=1e-4)


@pytest.fixture(scope="module")
def odd_events(tmp_path_factory):
    """Each type of event with values of zero and others that a table should not have; a folder and its SQL."""
    folder, c = tmp_path_factory.mktemp("odd"), duckdb.connect()
    values = "[0.0, -0.0, 'nan', 'inf', '-inf', NULL, 1e-300, 0.01, 560.21, 100]"
    c.execute(f"CREATE TABLE events AS SELECT row_number() OVER () AS event_id, (row_number() OVER ()) % 7 AS user_id, t AS event_type, v AS value FROM (SELECT unnest(['click', 'view', 'signup', 'error', 'purchase']) AS t), (SELECT unnest({values}::DOUBLE[]) AS v), range(3)")
    c.execute(f"COPY events TO '{folder}/events.parquet' (FORMAT parquet)")
    return str(folder), c


def exactly(rows):
    return sorted((tuple(repr(v + 0.0) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", ["leg_sizes", "quoted_levels"])
def test_odd_values_are_those_of_the_sql(spark, odd_events, name):
    folder, c = odd_events
    df = catalogue.QUERIES[name](spark, folder)
    found = c.execute(f"SELECT {', '.join(df.columns)} FROM ({catalogue.ORACLE_SQL[name]})").fetchall()
    assert exactly(df.collect()) == exactly(found)


@pytest.fixture(scope="module")
def fine_events(tmp_path_factory):
    """Prices so small or large that rounding to six places shows in the last bits, or that end halfway between what is printed."""
    folder, c = tmp_path_factory.mktemp("fine"), duckdb.connect()
    values = "[1.37e-9 * i, 8.894 + i / 100, i * 123456.789012345]"
    c.execute(f"CREATE TABLE events AS SELECT row_number() OVER () AS event_id, (row_number() OVER ()) % 7 AS user_id, t AS event_type, v AS value FROM (SELECT unnest(['view', 'signup', 'error']) AS t), (SELECT unnest({values}::DOUBLE[]) AS v FROM range(1, 400) AS r(i))")
    c.execute(f"COPY events TO '{folder}/events.parquet' (FORMAT parquet)")
    return str(folder), c


@pytest.mark.parametrize("name", ["leg_sizes", "quoted_levels"])
def test_fine_values_are_rounded_and_printed_as_by_the_sql(spark, fine_events, name):
    folder, c = fine_events
    df = catalogue.QUERIES[name](spark, folder)
    found = c.execute(f"SELECT {', '.join(df.columns)} FROM ({catalogue.ORACLE_SQL[name]})").fetchall()
    assert exactly(df.collect()) == exactly(found)


def test_calendar_window_works_before_its_join(spark):
    """The rows are as many as subjects and market-wide events multiplied: nothing is rounded or cast for each of them, and they are dealt out."""
    plan = catalogue.QUERIES["calendar_window"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    above = [p.split("Join ")[0] for p in plan.split("Union")[0:1]] + [p for p in plan.split("Union")[1].split("Join ")[:1]]
    assert not any("round(" in p or "cast(" in p for p in above)
    assert "RepartitionByExpression" in plan


def test_calendar_window_is_written_in_little_room(spark, tmp_path):
    """Rows that repeat every subject for every event lie so that they cost next to nothing, however many events a day has."""
    from datetime import date

    from pyspark.sql import functions as F

    from foldmark.operators import evidence

    day = F.lit(date(2024, 1, 3))
    asked = spark.range(64).select(F.col("id").alias("subject"), day.alias("day"))
    events = spark.range(40_000).select(F.lit(None).cast("long").alias("subject"), day.alias("day"), (F.col("id") * 7919 % 40_009).alias("event"), F.rand(1).alias("surprise"))
    evidence.calendar_window(asked, events, asked.select("day").distinct(), 3, 2, iso=True).write.parquet(f"{tmp_path}/out")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == out.select("subject", "event").distinct().count() == 64 * 40_000
    assert sum(f.stat().st_size for f in tmp_path.glob("out/*.parquet")) < 64 * 40_000 * 0.7


@pytest.mark.parametrize("which", ["true", "user_id % 40 <> 7", "dayofweek(ts) IN (0, 6)", "false"])
def test_calendar_window_of_odd_events(spark, tmp_path, which):
    """Without subjects and days, with events that repeat, without market-wide ones or trading days, and without any."""
    (tmp_path / "all").mkdir()
    _odd_events(tmp_path / "all", True)
    c = duckdb.connect()
    c.execute(f"CREATE TABLE events AS SELECT * FROM '{tmp_path}/all/events.parquet' WHERE {which}")
    c.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    df = catalogue.QUERIES["calendar_window"](spark, str(tmp_path))
    found = c.execute(f"SELECT {', '.join(df.columns)} FROM ({catalogue.ORACLE_SQL['calendar_window']})").fetchall()
    assert exactly(df.collect()) == exactly(found)


def _odd_events(folder, repeated):
    """Events without a subject, kind, day or properties, and with ids that repeat, for the same subject and another."""
    gone = ", ".join(f"CASE WHEN event_id % {n} <> 5 THEN {c} END AS {c}" for c, n in (("user_id", 37), ("event_type", 41), ("ts", 43), ("props", 47)))
    again = "UNION ALL SELECT * FROM e WHERE event_id % 10 = 0 UNION ALL SELECT * REPLACE (user_id + 1 AS user_id) FROM e WHERE event_id % 11 = 0" if repeated else ""
    duckdb.sql(f"COPY (WITH e AS (SELECT * REPLACE ({gone}) FROM '{FOLDER}/events.parquet') SELECT * FROM e {again}) TO '{folder}/events.parquet' (FORMAT parquet)")


@pytest.mark.parametrize("repeated", [False, True])
@pytest.mark.parametrize("name", ["recovery_by_subject", "recovered_signals", "citation_scores"])
def test_scores_of_odd_events(spark, tmp_path, name, repeated):
    _odd_events(tmp_path, repeated)
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    df = catalogue.QUERIES[name](spark, str(tmp_path))
    found = c.execute(f"SELECT {', '.join(df.columns)} FROM ({catalogue.ORACLE_SQL[name]})").fetchall()
    assert sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr) == sorted((tuple(plain(v) for v in r) for r in found), key=repr)


def test_recovery_by_subject_reads_the_events_few_times(spark):
    plan = catalogue.QUERIES["recovery_by_subject"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("Relation [") <= 6
