"""Name search against the comparison of every query with the whole catalogue."""

import random
import re
from difflib import SequenceMatcher

import pytest

from foldmark.operators import names


def brute(queries, catalogue, k=5, least=0.5, shorthand=None):
    words = {i: set(re.findall("[a-z0-9]+", n.lower())) | set(re.findall("[a-z0-9]+", i.lower())) for i, n, *_ in catalogue}
    held = {}
    for own in words.values():
        for w in own:
            held[w] = held.get(w, 0) + 1
    common = {w for w, n in held.items() if n > len(catalogue) / 4}
    out = []
    for q, text in queries:
        asked = (text or "").strip().lower()
        said = set(re.findall("[a-z0-9]+", asked))
        if not said:
            continue
        named = {(shorthand or {}).get(w, w.upper()) for w in said}
        scored = []
        for i, n, *alias in catalogue:
            ratio = max(SequenceMatcher(None, asked, t.lower(), autojunk=False).ratio() for t in (n, i))
            scored.append((max(len((said - common) & words[i]) / len(said), ratio) + (bool(alias) and alias[0] in named), i))
        best = sorted((s for s in scored if s[0] >= least), key=lambda s: (-s[0], s[1]))[:k]
        out += [(q, i, round(s, 9), place + 1) for place, (s, i) in enumerate(best)]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r.id, round(r.score, 9), r.place) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_same_best_as_the_whole_catalogue(spark, seed):
    rng = random.Random(seed)
    kinds, places = ["bank", "steel", "union", "global", "first", "energy", "power"], ["north", "south", "east", "corp", "ltd", "holding"]
    catalogue = [(f"EQ-{k:04d}", " ".join(rng.choice(x) for x in (kinds, places, kinds))) for k in range(120)]
    catalogue += [(f"XX-{k}", "Same Name") for k in range(12)] + [("A", "b"), ("EQ-X", ""), ("long", "abc " * 40)]
    queries = [(k, rng.choice(catalogue)[1]) for k in range(10)]
    queries = [(k, "".join(c for c in t if rng.random() > 0.1)) for k, t in queries]
    queries += [(20, "same name"), (21, "  EQ-0007 "), (22, "zzzz"), (23, ""), (24, None), (25, "?!"), (26, "b"), (27, "power bank of the south"), (28, "abc " * 39), (29, "same name")]
    found = names.best_names(spark.createDataFrame(queries, "query_id int, text string"), spark.createDataFrame(catalogue, "id string, name string"))
    assert got(found) == brute(queries, catalogue)


def test_aliases_and_their_shorthand(spark):
    catalogue = [("C-USD", "Treasury curve", "USD"), ("C-EUR", "Bund curve", "EUR"), ("EQ-1", "Dollar stores", None), ("EQ-2", "usd coin", None)]
    queries = [(1, "usd"), (2, "UST"), (3, "bund"), (4, "eur curve"), (5, "dollar")]
    short = {"ust": "USD", "bund": "EUR"}
    found = names.best_names(spark.createDataFrame(queries, "query_id int, text string"), spark.createDataFrame(catalogue, "id string, name string, alias string"), shorthand=short)
    assert got(found) == brute(queries, catalogue, shorthand=short)


def test_bounds_hold_for_random_texts():
    """What two texts with a similarity of r share at least: pairs of signs, and single signs."""
    from collections import Counter

    rng = random.Random(5)
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
        b = "".join(c for c in a if rng.random() > 0.2) + "".join(rng.choice("abc") for _ in range(rng.randint(0, 3)))
        r = SequenceMatcher(None, a, b, autojunk=False).ratio()
        share = lambda n, x=a, y=b: sum((Counter(x[k : k + n] for k in range(len(x) - n + 1)) & Counter(y[k : k + n] for k in range(len(y) - n + 1))).values())
        total = len(a) + len(b)
        assert share(2) >= (1.5 * r - 1) * total - 1 - 1e-9 and share(1) >= r * total / 2 - 1e-9


def test_resolution_by_id_then_name(spark):
    catalogue = spark.createDataFrame([("A", "B"), ("B", "x"), ("C", "Twice"), ("D", "TWICE"), ("E", None)], "id string, name string")
    queries = spark.createDataFrame([(1, "B"), (2, "b"), (3, "twice"), (4, "none"), (5, None)], "query_id int, text string")
    assert {r.query_id: r.id for r in names.resolved(queries, catalogue).collect()} == {1: "B", 2: "A", 3: "C", 4: None, 5: None}
