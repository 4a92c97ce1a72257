"""Leaks, pooled cells and estimates against plain loops."""

import itertools
import math
import random
import re
import time

import pytest

from foldmark.operators import estimators, patterns, pooled
from foldmark.operators.estimators import Estimator


def test_names_as_whole_words_against_a_search_for_each(spark):
    rng = random.Random(1)
    names = [(f"par_{k}_{rng.choice('abc')}", rng.choice(["bias", "preference"])) for k in range(1500)]
    names += [("loss_aversion", "bias"), ("plain", "preference"), ("plain", "bias"), ("éa_b", "preference"), ("(x)_", "preference"), ("a_b", "bias"), ("", "bias"), (None, "bias")]
    bits = ["par_1_a", "PAR_2_B", "par 3 c", "loss aversion", "Loss_Aversion", "loss_aversions", "plain", "éa_b", "(x)_", "a_b", "a b", "xa_b", " ", ". ", "-", "par_1_ab"]
    turns = [(s, rng.choice(["user", "assistant", None]), rng.choice([None, "", "".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(6))])) for s in range(60) for _ in range(4)]
    want = {}
    for s, role, text in turns:
        if role != "user" or not text:
            continue
        for name, kind in names:
            forms = [] if not name else [name, name.replace("_", " ")] if kind == "bias" else [name] if "_" in name else []
            if any(re.search(rf"\b{re.escape(f.lower())}\b", text.lower()) for f in forms):
                want.setdefault(s, set()).add(f"names a parameter: {name}")
    df, own = spark.createDataFrame(turns, "s int, role string, text string"), spark.createDataFrame(names, "name string, kind string")
    for letters in (patterns.BLOCK_LETTERS, 3000):  # one automaton, and several
        assert {r.s: r.reasons for r in patterns.leaks(df, own, ["s"], "user", letters).collect()} == {s: sorted(x) for s, x in want.items()}
    assert patterns.leaks(df, own.limit(0), ["s"], "user").collect() == []


def test_names_are_joined_and_no_task_of_python_holds_them(spark):
    texts = spark.createDataFrame([(1, "user", "(a_b) éa_b a_b"), (2, "user", "-- a_b --"), (3, "user", "--"), (4, "user", "x--y, 𝒳_1"), (5, "user", "a_b.."), (6, "user", None)], "s int, role string, text string")
    own = spark.createDataFrame([(n, "preference") for n in ("a_b", "(a_b", "a_b)", "_--", "x--y_", "éa_b", "𝒳_1", " a_b ")] + [("x--y", "bias"), ("--", "bias"), ("-- a_b", "bias")], "name string, kind string")
    for letters in (patterns.BLOCK_LETTERS, 0):
        found = patterns.leaks(texts, own, ["s"], "user", letters)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
        short = {r.s: [x.removeprefix("names a parameter: ") for x in r.reasons] for r in found.collect()}
        assert short == {1: ["a_b", "éa_b"], 2: ["a_b"], 4: ["--", "x--y", "𝒳_1"], 5: ["a_b"]}
        for r in texts.where("text IS NOT NULL").collect():  # as a search for each would find
            assert short.get(r.s, []) == sorted(n for (n, _) in own.collect() if ("_" in n or n in ("x--y", "--", "-- a_b")) and re.search(rf"\b{re.escape(n)}\b", r.text))


def tail(chances, hits):
    """The dynamic programme over all tries."""
    mass = [1.0]
    for p in chances:
        mass = [a * (1 - p) + b * p for a, b in zip([*mass, 0.0], [0.0, *mass])]
    return sum(mass[max(0, hits) :])


def test_tails_are_those_of_the_dynamic_programme():
    rng = random.Random(2)
    for _ in range(200):
        chances = [rng.choice([0.5, 1 / 3, 0.25, 0.0, 1.0, rng.random()]) for _ in range(rng.randint(1, 40))]
        mix = [(p, chances.count(p)) for p in set(chances)]
        for hits in (-1, 0, 1, len(chances) // 2, len(chances), len(chances) + 1):
            assert pooled.upper_tail(mix, hits) == pytest.approx(tail(chances, hits), abs=1e-12, rel=1e-9)
    few = [0.1, 0.5, 0.25]
    assert pooled.upper_tail([(p, 1) for p in few], 2) == pytest.approx(sum(math.prod(p if on else 1 - p for p, on in zip(few, c)) for c in itertools.product([0, 1], repeat=3) if sum(c) >= 2))


def test_a_large_cell_takes_seconds(spark):
    began = time.time()
    mix = [(0.5, 400_000), (1 / 3, 400_000), (0.25, 200_000)]
    mean, sd = sum(p * n for p, n in mix), math.sqrt(sum(p * (1 - p) * n for p, n in mix))
    for z in (-2, 0, 2):
        assert pooled.upper_tail(mix, round(mean + z * sd)) == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), abs=2e-3)
    rows = spark.range(1_000_000).selectExpr("1 AS cell", "1D / (2 + id % 3) AS chance", "id % 11 < 4 AS hit")
    found = pooled.pooled_cells(rows, ["cell"], 0.05, 5).first()
    assert found.n == 1_000_000 and found.verdict == "pass" and time.time() - began < 60


def test_cells_without_power_are_insufficient(spark):
    rows = [("few", 0.5, True)] * 4 + [("likely", 0.99, True)] * 5 + [("pass", 0.2, True)] * 5 + [("fail", 0.5, k < 3) for k in range(6)] + [("pass", None, True), ("pass", 0.5, None)]
    found = {r.cell: (r.verdict, r.p) for r in pooled.pooled_cells(spark.createDataFrame(rows, "cell string, chance double, hit boolean"), ["cell"], 0.05, 5).collect()}
    assert found["few"] == ("insufficient", None) and found["likely"] == ("insufficient", None)
    assert found["pass"] == ("pass", pytest.approx(0.2**5)) and found["fail"] == ("fail", pytest.approx(tail([0.5] * 6, 3)))


def test_loss_aversion_leaves_out_what_is_no_opportunity(spark):
    schema = "s string, pnl_state string, trigger_pending boolean, action string, day int, last_day int, no_add boolean, triggers_fired int"
    rows = [
        ("a", "loss", False, "add", 1, 9, False, 0), ("a", "loss", False, "hold", 2, 9, False, 0), ("a", "gain", False, "add", 3, 9, False, 0), ("a", "loss", True, "add", 4, 9, False, 0),
        ("a", "loss", False, "roll", 5, 9, False, 0), ("a", "loss", False, "add", 9, 9, False, 0), ("b", "loss", False, "add", 1, 9, True, 0), ("b", "loss", False, "add", 2, 9, True, 1), ("c", "gain", False, "add", 1, 9, False, 0),
    ]
    found = estimators.estimate_all(spark.createDataFrame(rows, schema), ["s"], [estimators.loss_aversion()], {"all": "true", "early": "day < 2"})
    assert {(r.s, r.split): (r.value, r.n, r.n_counted) for r in found.collect()} == {
        ("a", "all"): (0.5, 2, 2), ("a", "early"): (1.0, 1, 1), ("b", "all"): (1.0, 1, 2), ("b", "early"): (None, 0, 1), ("c", "all"): (None, 0, 0), ("c", "early"): (None, 0, 0)
    }


def test_all_parameters_in_one_scan_and_what_blocks(spark):
    rows = [(f"s{k}", float(k % 2), k % 2 == 1, j) for k in range(24) for j in range(6)]
    df = spark.createDataFrame([(s, on, j < (1 if not active else 4) + (int(s[1:]) % 3 == 0)) for s, on, active, j in rows], "s string, x double, hit boolean")
    registry = [Estimator("strong", "true", "hit"), Estimator("flat", "true", "true"), Estimator("gone", "false"), Estimator("report", "true", "false", blocking=False)]
    estimates = estimators.estimate_all(df, ["s"], registry, {"all": "true"})
    plan = estimates._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("Exchange hash") == 1
    traits = spark.createDataFrame([(f"s{k}", e.param, k % 2 == 1, k % 3) for k in range(24) for e in registry if e.param != "gone"], "s string, param string, active boolean, g int")
    failures = estimators.blocking_failures(estimators.judged(estimates, traits, "s", "g"), registry)
    assert sorted(r.failure for r in failures.collect()) == ["all/flat", "all/gone: missing"]
    with pytest.raises(ValueError, match="twice"):
        estimators.estimate_all(df, ["s"], [registry[0], registry[0]], {"all": "true"})


def test_exact_tests_of_cells_of_any_size(spark):
    from foldmark.operators import stats

    rows = spark.createDataFrame([(6, 2**33, 2**33, 10), (0, 2**33, 5, 4), (3, 3, 2**40, 3), (20, 40, 40, 30)], "h long, a long, b long, p long")
    found = {r.h: r.q for r in rows.withColumn("q", stats.fisher_upper("h", "a", "b", "p")).collect()}
    choose = math.comb
    assert found[6] == pytest.approx(sum(choose(10, k) for k in range(6, 11)) / 1024, rel=1e-3)
    assert found[0] == pytest.approx(1.0, abs=1e-4) and found[3] == pytest.approx(6 / 2.0**120, rel=0.1)
    assert found[20] == pytest.approx(sum(choose(40, k) * choose(40, 30 - k) for k in range(20, 31)) / choose(80, 30), rel=1e-9)
