import itertools
import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from foldmark.functions import dates, replies, text
from foldmark.operators import asof, cells, evidence, machine, rank, stats, windows
from foldmark.sources import tables


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_asof_is_inclusive_and_crosses_days(spark):
    t = lambda d, h: datetime(2024, 1, d, h)
    left = spark.createDataFrame([(1, "a", t(1, 5)), (2, "a", t(9, 1)), (3, "a", t(1, 1)), (4, "b", t(2, 2)), (5, None, t(2, 2))], "id int, k string, ts timestamp")
    right = spark.createDataFrame([("a", t(1, 5), 1.0), ("a", t(3, 5), 2.0), ("a", t(3, 5), 3.0), (None, t(1, 1), 9.0)], "k string, ts timestamp, v double")
    assert rows(asof.asof_backward(left, right, "k", "ts", "v", "got"), "id", "got") == [(1, 1.0), (2, 3.0), (3, None), (4, None), (5, None)]


def test_tolerance_anti(spark):
    a = spark.createDataFrame([(1, 100.0), (2, 100.0), (3, 5.0)], "k int, v double")
    b = spark.createDataFrame([(1, 100.4), (2, 102.0)], "k int, v double")
    assert rows(asof.tolerance_anti(a, b, ["k"], "v", 0.005), "k") == [(2,), (3,)]


def test_run_counter_and_streak(spark):
    x = spark.createDataFrame([("a", i, v) for i, v in enumerate([1, 5, 5, None, 5, 5, 5])], "k string, t int, v int")
    assert [r.run for r in windows.run_counter(x, "k", ["t"], F.col("v") > 3).orderBy("t").collect()] == [0, 1, 2, 0, 1, 2, 3]
    d = spark.createDataFrame([("a", date(2024, 1, i)) for i in (1, 2, 4, 5, 5, 9)], "k string, d date")
    assert rows(windows.longest_streak(d, "k", "d"), "days", "first_day") == [(2, date(2024, 1, 1))]


def test_forward_fill_counts_days_since(spark):
    days = spark.createDataFrame([("a", date(2024, 1, i)) for i in range(1, 5)], "k string, d date")
    values = spark.createDataFrame([("a", date(2024, 1, 2), 7.0)], "k string, d date, v double")
    assert rows(windows.forward_fill(days, values, "k", "d", "v"), "filled", "run")[-1] == (None, None)
    assert (7.0, 2) in rows(windows.forward_fill(days, values, "k", "d", "v"), "filled", "run")


def test_ema_moves_by_the_gap(spark):
    x = spark.createDataFrame([("a", date(2024, 1, 1), 0.0), ("a", date(2024, 1, 8), 10.0)], "k string, d date, v double")
    assert windows.ema_fold(x, "k", "d", "v", 7.0).first().ema == pytest.approx(5.0)


def test_spearman_ties_and_constants(spark):
    x = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 1, 1), ("b", 1, 2), ("b", 1, 3), ("c", 1, 1)], "k string, x int, y int")
    got = {r.k: r.rho for r in stats.spearman(x, ["k"], "x", "y").collect()}
    assert got["a"] == pytest.approx(math.sqrt(3) / 2) and got["b"] is None and got["c"] is None


def test_fisher_against_enumeration(spark):
    a, b, drawn = 4, 3, 3
    x = spark.createDataFrame([(h, a, b, drawn) for h in range(5)], "h long, a long, b long, p long")
    for r in x.withColumn("q", stats.fisher_upper("h", "a", "b", "p")).collect():
        draws = list(itertools.combinations(range(a + b), drawn))
        assert r.q == pytest.approx(sum(sum(i < a for i in c) >= r.h for c in draws) / len(draws))


def test_poisson_binomial_against_enumeration(spark):
    ps = [0.1, 0.5, 0.25, 0.9, 0.3, 0.6]
    x = spark.createDataFrame([(ps, h) for h in range(8)], "c array<double>, h long")
    for r in x.withColumn("q", stats.poisson_binomial_upper("c", "h")).collect():
        want = sum(math.prod(p if on else 1 - p for p, on in zip(ps, c, strict=True)) for c in itertools.product([0, 1], repeat=6) if sum(c) >= r.h)
        assert r.q == pytest.approx(want, abs=1e-12)


def test_cells_count_missing_and_judge(spark):
    x = spark.createDataFrame([(float(i % 3), False, 1) for i in range(9)] + [(9.0 + i % 2, True, 1) for i in range(6)] + [(None, True, 2)], "value double, active boolean, g int")
    got = {(r.kind, r.cell): r for r in cells.gate_cells(cells.memberships(x, {"group": "g"})).collect()}
    assert got["pool", "all"].verdict == "pass" and got["pool", "all"].n_missing == 1
    assert got["group", "2"].verdict == "insufficient" and not got["group", "2"].gap_ok and got["group", "2"].neutral_mean is None


def test_largest_remainder(spark):
    x = spark.createDataFrame([("a", "x", 1, 10), ("a", "y", 1, 10), ("a", "z", 1, 10), ("b", "x", 0, 3), ("b", "y", 0, 3)], "k string, n string, w int, total int")
    assert rows(rank.largest_remainder(x, ["k"], "w", "total", "n"), "k", "n", "share") == [("a", "x", 4), ("a", "y", 3), ("a", "z", 3), ("b", "x", 0), ("b", "y", 0)]


def test_third_friday_and_weekdays(spark):
    days = dates.weekdays(spark, "2024-01-03", "2024-02-29").orderBy("day").collect()
    assert [r.t for r in days] == list(range(len(days)))
    x = spark.createDataFrame([(date(2024, 3, 31),), (date(2024, 3, 1),)], "d date")
    assert {r[0] for r in x.select(dates.third_friday(F.col("d"))).collect()} == {date(2024, 3, 15)}


def column(spark, values, fn, kind="string"):
    return [r[0] for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, t {kind}").select("k", fn(F.col("t")).alias("x")).orderBy("k").select("x").collect()]


def test_option_letters(spark):
    texts = ["B) yes", "(C)", "Apple", "D", "- a", " (B). so", "A\nor C", "AB", "", "E", "(D", "C:x"]
    assert column(spark, texts, replies.option_letter) == ["B", "C", None, "D", None, "B", "A", None, None, None, "D", "C"]
    assert column(spark, ["A", "B", "C", "D"], lambda t: replies.option_letter(t, 2)) == ["A", "B", None, None]


def test_forms_of_replies(spark):
    one = lambda fn, *texts: column(spark, texts, fn)
    assert one(replies.bullets, "- a\n- b", "1. a\n2) b\n\n* c", "- a", "-a\n-b", "- a\nb", "12x\n- b") == [True, True, False, False, False, False]
    assert one(replies.paragraph, "One para.\n", "a | b | c", "#tag first", "# Head", "a\n\nb", "a\nb", "- x", "a | b", "") == [True, False, True, False, False, True, False, True, True]
    assert one(replies.table, "| a | b |\n|---|:--:|", "| a | b |\n|---|---|\n| 1 | 2 |", "a | b | c\n--- | --- | ---", "| a | b |\n| c | d |", "|---|---|") == [False, True, True, False, False]
    assert one(replies.headers, "# a\nx\n## b", "# a", "#a\n#b", "####### a\n# b") == [True, False, False, False]
    assert one(replies.sentence_count, "One. Two! Three?", "", "none", "3.5 is one", "a.  b", "  \n ") == [3, 0, 1, 1, 2, 0]
    assert one(lambda t: replies.units(t, True, False), "12bp", "5 basis points", "3%", "12bps and 3%", "abp", "none") == ["pass", "pass", "fail", "fail", "not_applicable", "not_applicable"]
    assert one(replies.hedged, "It may be", "In May", "Perhaps.", "mighty", "unlikely") == [True, False, True, False, True]
    assert one(replies.confident, "High confidence.", "conviction is 80%", "up 80%", "confidence level of medium", "highconfidence") == [True, True, False, True, False]


def test_routine_answers(spark):
    texts = ["format: a=b; c=d; intrusion: none", "format: none; intrusion: none", "format: x=y z=w; intrusion: none", "format: a=; intrusion: none", "format: a=b; a=c; intrusion: none", "format: x; intrusion: none", "a=b", "format: x=y z; intrusion: none"]
    got = column(spark, texts, replies.routine_pairs)
    assert [g if g is None else [tuple(x) for x in g] for g in got] == [[("a", "b"), ("c", "d")], [], None, None, [("a", "b"), ("a", "c")], None, None, [("x", "y z")]]


def test_judgement_details(spark):
    rows_ = [("intrusion", "intrudes=true; evidence=a=b; evidence=c", False), ("format", "x=y: z: fail; p=q: pass", False), ("format", "p=q: not_applicable", True), ("in_situ", "a=true; b=false", False), ("open", "choice=C", False), ("open", "choice=B", True), ("open", "empty reply", False)]
    x = spark.createDataFrame(rows_, "judge string, detail string, correct boolean")
    got = [r.s for r in x.select(replies.judged(F.col("correct"), F.col("detail"), F.col("judge")).alias("s")).collect()]
    assert [g.detail for g in got] == ["evidence=a=b; evidence=c", "x=y: z", None, "b", "chose=C", None, "empty reply"] and [g.scored for g in got] == [True, True, False, True, True, True, True]


def test_redistribution_against_a_loop(spark):
    import random

    rng, cases, want = random.Random(1), [], []
    for _ in range(200):
        n = rng.randint(1, 5)
        shares, counts = [rng.randint(0, 9) for _ in range(n)], [rng.randint(0, 12) for _ in range(n)]
        own = [min(s, c) for s, c in zip(shares, counts)]
        spare = sum(shares) - sum(own)
        while spare and any(o < c for o, c in zip(own, counts)):
            for k in range(n):
                if spare and own[k] < counts[k]:
                    own[k] += 1
                    spare -= 1
        cases.append((len(cases), shares, counts))
        want.append(own)
    x = spark.createDataFrame(cases, "k int, s array<long>, c array<long>")
    assert [r.n for r in x.select("k", evidence.redistributed(F.col("s"), F.col("c")).alias("n")).orderBy("k").collect()] == want


def test_merge_refuses_unequal_rows(spark):
    a, b = (spark.createDataFrame(v, "id int, n string") for v in ([(1, "x"), (2, "y")], [(2, "y"), (3, "z")]))
    assert rows(evidence.merged(a, b, "id"), "id", "n") == [(1, "x"), (2, "y"), (3, "z")]
    with pytest.raises(Exception, match="unequal rows of id 2"):
        evidence.merged(a, spark.createDataFrame([(2, "other")], "id int, n string"), "id").collect()


def test_calendar_window_on_holidays_and_at_the_ends(spark):
    axis = [date(2024, 1, x) for x in (2, 3, 4, 5, 8, 9)]
    asked = spark.createDataFrame([("a", date(2024, 1, 6)), ("b", date(2024, 1, 2)), ("c", date(2024, 2, 1))], "subject string, day date")
    every = [(None, date(2024, 1, 1) + __import__("datetime").timedelta(k), k, float(k)) for k in range(40)] + [("a", date(2024, 1, 9), 99, 9.0)]
    out = evidence.calendar_window(asked, spark.createDataFrame(every, "subject string, day date, event int, surprise double"), spark.createDataFrame([(x,) for x in axis], "day date"), 1, 1)
    got = {s: sorted(r.day.day if r.day.month == 1 else 31 + r.day.day for r in out.collect() if r.subject == s) for s in "abc"}
    assert got["a"] == [5, 6, 7, 8] and got["b"] == [2, 3] and got["c"][0] == 9 and got["c"][-1] == 32
    assert all((r.surprise is None) == (r.day > r.today) for r in out.collect())


def test_rendered_lines(spark):
    x = spark.createDataFrame([("a", 1), (None, 2)], "e string, n int")
    got = [r[0] for r in x.select(replies.rendered(F.lit("{event} at {level}"), event=F.col("e"), level=F.col("n"))).collect()]
    assert got == ["a at 1", None] and x.select(replies.rendered(F.lit("{event} {other}"), event=F.col("e"))).first()[0] is None


def test_state_machine_streams_in_order(spark):
    x = spark.createDataFrame([(1, i, p) for i, p in enumerate([10.0, 9.5, 9.0, 12.0, 5.0])], "k long, t int, price double")

    def step(book, row):
        book, action = machine.trade(book, row.price, 1.0, 0.2, 0.2, 2)
        return book, (row.k, row.t, action)

    assert [r[2] for r in rows(machine.fold(x, "k", ["t"], "k long, t int, action string", machine.Book, step), "k", "t", "action")] == ["enter", "add", "add", "target", "enter"]


def test_tables_check_keys_and_invariants(spark, tmp_path):
    t = tables.TABLES["responses"]
    x = spark.createDataFrame([("p2", "m", "x", 1), ("p1", "m", None, 2)], t.schema)
    for kind in ("parquet", "json"):
        path = f"file://{tmp_path}/{kind}"
        tables.write(x, t, path, kind)
        tables.write(x, t, path, kind)
        assert rows(tables.read(spark, t, path, kind), "probe_id", "response") == [("p1", None), ("p2", "x")]
    with pytest.raises(ValueError, match="unique"):
        tables.write(x.unionByName(x), t, f"file://{tmp_path}/twice")
    rules = tables.TABLES["rules"]
    with pytest.raises(ValueError, match="one level"):
        tables.checked(spark.createDataFrame([("a", "b", "f", "<", 1.0, "x", 1, "go")], rules.schema), rules)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.json").write_text('{"probe_id":"a","pm_id":"b","response":"c","latency_ms":1,"more":2}\n')
    with pytest.raises(ValueError, match="bad line"):
        tables.read(spark, t, f"file://{tmp_path}/bad", "json")
    mixed = tables.split_mixed(spark.createDataFrame([("1.5",), ("high",)], "level string"), "level")
    assert rows(mixed, "level_num", "level_text") == [(1.5, None), (None, "high")]
    assert rows(tables.join_mixed(mixed, "level"), "level") == [("1.5",), ("high",)]


def test_hidden_columns_stay_behind(spark):
    c = spark.createDataFrame([(1, "n", 2, 3.0, "s")], tables.TABLES["customer"].schema)
    assert tables.public("customer", c).columns == ["c_custkey", "c_nationkey", "c_mktsegment"]


def test_replay_sees_nothing_late(spark):
    from foldmark.streaming.replay import LastHeard, Silent, replay

    s = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 1, None)], "subject string, at int, text string")
    p = spark.createDataFrame([("a", 0, "p0", "?"), ("a", 1, "p1", "?"), ("a", 2, "p2", "?"), ("a", 3, "p3", "?"), ("b", 5, "p4", "?"), ("c", 5, "p5", "?")], "subject string, at int, probe_id string, question string")
    assert rows(replay(s, p, LastHeard), "probe_id", "response") == [("p0", ""), ("p1", "x"), ("p2", "x"), ("p3", "y"), ("p4", ""), ("p5", "")]
    assert {r.response for r in replay(s, p, Silent).collect()} == {""}


def test_reply_parsers(spark):
    x = spark.createDataFrame([('so {"k": 1} and {"k": 2, "s": "9 {x"}',), ("no",)], "t string")
    got = x.select(text.numbers_in(F.lit('{"a": [1, -2.5e1, "7"], "b3": true}')), text.last_json(F.col("t"), "k int")).collect()
    assert got[0][0] == [1.0, -25.0]
    assert got[1][1] is None


def test_normal_quantile_and_scalar_rules(spark):
    from statistics import NormalDist

    from foldmark.functions import numbers

    ps = [1e-9, 0.001, 0.02, 0.3, 0.5, 0.77, 0.999]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in ps], "p double").select(numbers.normal_quantile(F.col("p"))).collect()]
    assert got == pytest.approx([NormalDist().inv_cdf(p) for p in ps], abs=1e-6)
    one = spark.range(1).select(numbers.half_up(F.lit(2.5)), numbers.bucket(F.lit(5.0), [1, 5]), numbers.regime_multiplier(F.lit(0.5), F.lit(1.0)), *numbers.blend(F.lit(1.0), F.lit(3.0), F.lit(0.5)))
    assert list(one.first()) == pytest.approx([3, 3, 0.5, 2.0, 2.0 * 2**0.5])


def test_ratings_parts_and_metadata(spark, tmp_path):
    (tmp_path / "r.csv").write_text("﻿probe_id,rating\na,Yes\nb, no \nc,\nd,maybe\n", encoding="utf-8")
    assert rows(tables.read_ratings(spark, f"file://{tmp_path}/r.csv"), "probe_id", "rating") == [("a", True), ("b", False), ("d", None)]
    path = f"file://{tmp_path}/parts"
    tables.append_parts(spark.createDataFrame([("p1", 1), ("p2", 2)], "pm_id string, v int"), "pm_id", path)
    tables.append_parts(spark.createDataFrame([("p2", 3)], "pm_id string, v int"), "pm_id", path)
    done = spark.read.parquet(path)
    assert rows(done, "pm_id", "v") == [("p1", 1), ("p2", 3)]
    wanted = spark.createDataFrame([("p1",), ("p3",)], "pm_id string")
    assert rows(tables.pending(wanted, done, ["pm_id"]), "pm_id") == [("p3",)]
    tables.metadata(spark, f"file://{tmp_path}/meta", {"rows": 3, "seed": "x"})
    assert tables.metadata(spark, f"file://{tmp_path}/meta") == {"rows": 3, "seed": "x"}


def test_precedence_samples_and_ids(spark):
    x = spark.createDataFrame([("d", 1, "stop"), ("d", 2, "trim"), ("e", 3, "roll")], "k string, id int, action string")
    ranked = rank.precedence(x, ["k"], [F.expr("array_position(array('stop', 'trim', 'roll'), action)"), F.col("id")])
    assert rows(ranked, "id", "status") == [(1, "acted"), (2, "overridden"), (3, "acted")]
    many = spark.range(200).withColumn("s", F.expr("id div 100"))
    picked = rank.stratified_sample(many, "s", 5, "seed", "id")
    assert {r[1] for r in picked.groupBy("s").count().collect()} == {5}
    assert rows(picked, "id") == rows(rank.stratified_sample(many.repartition(7), "s", 5, "seed", "id"), "id")
    u = [r[0] for r in many.select(rank.uniform("seed", "id")).collect()]
    assert 0 <= min(u) and max(u) < 1 and 0.4 < sum(u) / len(u) < 0.6


def test_asof_against_brute_force(spark):
    import random
    from datetime import timedelta

    rng, start = random.Random(5), datetime(2024, 1, 1)
    at = lambda: start + timedelta(hours=rng.randrange(24 * 12))
    left = [(i, rng.choice("aab"), at()) for i in range(300)]
    right = [(rng.choice("abc"), at(), float(v)) for v in range(80)]
    want = []
    for i, k, t in left:
        seen = [(u, v) for key, u, v in right if key == k and u <= t]
        want.append((i, max(seen)[1] if seen else None))
    got = asof.asof_backward(spark.createDataFrame(left, "id int, k string, ts timestamp"), spark.createDataFrame(right, "k string, ts timestamp, v double"), "k", "ts", "v", "got")
    assert rows(got, "id", "got") == sorted(want, key=repr)


def test_paired_with_next_is_strictly_later(spark):
    t = lambda h: datetime(2024, 1, 1, h)
    x = spark.createDataFrame([("a", t(1), "open"), ("a", t(1), "close"), ("a", t(3), "close"), ("a", t(4), "open")], "k string, ts timestamp, what string")
    got = asof.paired_with_next(x, "k", "ts", F.col("what") == "close", "until").where("what = 'open'")
    assert rows(got, "ts", "until") == sorted([(t(1), t(3)), (t(4), None)], key=repr)


def test_session_windows_of_a_stream(spark, tmp_path):
    from foldmark.streaming import windows as stream

    t = lambda d, h: datetime(2024, 1, d, h)
    events = spark.createDataFrame([(1, t(1, 1), 7, "x", 1.0, None), (2, t(1, 1), 7, "x", 1.0, None), (3, t(1, 5), 7, "x", 1.0, None), (4, t(9, 1), 8, "x", 1.0, None)], stream.EVENTS)
    events.write.parquet(f"{tmp_path}/in")
    q = stream.sessions(stream.read_events(spark, f"{tmp_path}/in", 10)).writeStream.outputMode("append").format("memory").queryName("sessions").start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.sql("SELECT user_id, n FROM sessions"), "user_id", "n") == [(7, 1), (7, 2)]


@pytest.mark.parametrize("rare", [0, 1, 3, 50])
def test_nearest_other_against_all_pairs(spark, rare):
    """Hot grams that all share, copies, subjects with none in common: the same whatever counts as rare."""
    import random

    from foldmark.operators import overlap

    rng = random.Random(rare)
    own = {k: {f"c{rng.randint(0, 6)}" for _ in range(rng.randint(0, 6))} | {f"r{rng.randint(0, 60)}" for _ in range(rng.randint(0, 8))} | {f"u{k}"} for k in range(40)}
    own[50], own[51] = set(own[3]), {"alone"}
    g = spark.createDataFrame([(k, x) for k, v in own.items() for x in sorted(v)], "k long, gram string")
    want = sorted((k, len(v), max(len(v & w) for j, w in own.items() if j != k)) for k, v in own.items())
    assert rows(overlap.nearest_other(g, "k", rare), "k", "own", "shared") == want or sorted(rows(overlap.nearest_other(g, "k", rare), "k", "own", "shared")) == want


def _shuffled_rows(spark):
    gateway = spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
    return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))


def test_nearest_other_makes_no_rows_for_pairs(spark):
    """Everybody holds common grams and half are near copies: rows that travel stay as many as grams, not as pairs."""
    import random

    from foldmark.operators import overlap

    rng = random.Random(7)
    own = {k: set(rng.sample(range(90), 60)) | {100 + k} for k in range(300)} | {k: set(range(200, 260)) - {200 + rng.randrange(60)} | {1000 + rng.randrange(9)} for k in range(300, 600)}
    g = spark.createDataFrame([(k, f"c{x}") for k, v in own.items() for x in sorted(v)], "k long, gram string").cache()
    n = g.count()
    before = _shuffled_rows(spark)
    got = rows(overlap.nearest_other(g, "k"), "k", "own", "shared")
    assert _shuffled_rows(spark) - before < 2 * n
    assert sorted(got) == sorted((k, len(v), max(len(v & w) for j, w in own.items() if j != k)) for k, v in own.items())


@pytest.mark.parametrize("rare", [0, 2, 50])
@pytest.mark.parametrize("block", [15, 60])
def test_nearest_other_in_blocks_of_any_size(spark, monkeypatch, rare, block):
    import random

    from foldmark.operators import overlap

    monkeypatch.setattr(overlap, "BLOCK_GRAMS", block)
    rng = random.Random(block)
    own = {f"s{k}": {f"c{min(rng.randint(0, 12), rng.randint(0, 12))}" for _ in range(rng.randint(1, 9))} for k in range(24)}
    own["s30"] = {f"c{x}" for x in range(13)}
    g = spark.createDataFrame([(k, x) for k, v in own.items() for x in sorted(v)], "k string, gram string")
    want = sorted((k, len(v), max(len(v & w) for j, w in own.items() if j != k)) for k, v in own.items())
    assert sorted(rows(overlap.nearest_other(g, "k", rare), "k", "own", "shared")) == want


def test_ranks_and_quantiles_of_skewed_values(spark):
    import random

    rng = random.Random(5)
    values = [("a", float(rng.choice([1, 1, 1, 2, rng.randint(3, 900)]))) for _ in range(3000)] + [("b", 4.0)] * 5 + [("c", 1.0)]
    x = spark.createDataFrame([(k, v, rng.random()) for k, v in values], "k string, v double, w double")
    got = {(r.k, r.v): r.r for r in stats.average_ranks(x, ["k"], "v", "r").collect()}
    for k in "abc":
        mine = sorted(v for j, v in values if j == k)
        assert all(got[k, v] == pytest.approx(mine.index(v) + (mine.count(v) + 1) / 2) for v in set(mine))
    q = stats.quantiles(x, "v", 0.9).first()
    every = sorted(v for _, v in values)
    n = len(every)
    assert (q.n, q.most, q.at) == (n, every[-1], every[math.ceil(0.9 * n) - 1]) and q.median == (every[(n - 1) // 2] + every[n // 2]) / 2
    assert stats.quantiles(x.limit(0), "v", 0.9).first().n == 0


def test_exact_tail_of_large_tables(spark):
    from math import comb

    cases = [(3, 5, 7, 6), (0, 4, 4, 4), (5, 5, 0, 5), (2, 400, 600, 300), (150, 400, 600, 300), (9, 5, 7, 6), (0, 0, 3, 2)]
    x = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, hits long, active long, inactive long, present long")
    got = [r.p for r in x.select("k", stats.fisher_upper("hits", "active", "inactive", "present").alias("p")).orderBy("k").collect()]
    want = [sum(comb(a, j) * comb(i, p - j) for j in range(h, min(a, p) + 1)) / comb(a + i, p) for h, a, i, p in cases]
    assert got == pytest.approx(want, rel=1e-6)
    big = spark.createDataFrame([(300_000, 600_000, 600_000, 600_000)], "hits long, active long, inactive long, present long")
    assert 0.49 < big.select(stats.fisher_upper("hits", "active", "inactive", "present")).first()[0] < 0.51


def test_forward_asof_crosses_days_and_skips_null_keys(spark):
    t = lambda d, h: datetime(2024, 1, d, h)
    x = spark.createDataFrame([(1, "a", t(1, 5), 0), (2, "a", t(1, 5), 1), (3, "a", t(9, 1), 1), (4, "b", t(2, 2), 0), (5, None, t(2, 2), 0), (6, None, t(3, 2), 1)], "id int, k string, ts timestamp, c int")
    assert rows(asof.paired_with_next(x, "k", "ts", F.col("c") == 1, "n"), "id", "n") == [(1, t(9, 1)), (2, t(9, 1)), (3, None), (4, None), (5, None), (6, None)]


def test_citations_are_scored(spark):
    signals = spark.createDataFrame([("s", "x", 1, 10, "self", "confirm"), ("s", "x", 2, 11, "self", "retracted"), ("s", "y", 3, 12, "desk", "confirm")], "subject string, trait string, signal_id int, session long, ownership string, valence string")
    sessions = spark.createDataFrame([("s", 10), ("s", 11), ("s", 12)], "subject string, session long")
    truths = spark.createDataFrame([("s", "x", "bias", True, None), ("s", "y", "preference", None, 2.0), ("s", "z", "preference", None, None)], "subject string, trait string, kind string, truth_active boolean, truth_value double")
    said = spark.createDataFrame([("s", "x", True, None, [10, 11, 99]), ("s", "y", None, 3.0, [12])], "subject string, trait string, predicted_active boolean, predicted_value double, cited array<long>")
    found, unknown = evidence.cited_rows(said, truths, signals, sessions)
    assert rows(found, "trait", "correct", "cited", "falsely") == [("x", True, "10,11", "11"), ("y", False, "12", "12"), ("z", True, "", "")]
    assert rows(unknown, "trait", "session") == [("x", 99)]
