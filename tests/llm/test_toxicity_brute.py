"""The net's scores against plain loops over words, windows and filters, one text at a time."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from foldmark.llm import toxicity as tox
from foldmark.llm import words as w

MASK = 2**64 - 1
MARKS = set(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))


def mixed(x):
    for _ in range(2):
        x ^= x >> 32
        x = x * 0xD6E8FEB86659FD93 & MASK
    return x ^ x >> 32


def hashed(data):
    return mixed(sum(int(w._BYTE[b]) * pow(int(w._BASE), k + 1, 2**64) for k, b in enumerate(data)) & MASK)


def folded(word):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or "À" <= c <= "Þ" else c for c in word)


def trimmed(word):
    for _ in range(4):
        if len(word) > 1 and word[-1] in MARKS:
            word = word[:-1]
        if len(word) > 1 and word[0] in MARKS:
            word = word[1:]
    return word


def plain_score(net, text):
    own = [folded(trimmed(x)) for x in re.findall("[^\x20\x09-\x0d]+", text)]
    x = []
    for word in own:
        data = word.encode()
        at = [hashed(data) % tox.SLOTS] + [(hashed(data[:size]) + k * 0x9E3779B9 & MASK) % tox.SLOTS for k, size in enumerate(tox._PREFIXES, 1)]
        x.append(sum(net.w["table"][p].astype(float) for p in at))
    zero = np.zeros(tox.DIM)
    pooled = []
    for width, rank in tox.POOLS:
        for f in range(tox.FILTERS):
            values = [sum(float((x[i + j] if i + j < len(x) else zero) @ net.w[f"f{width}"][j][:, f]) for j in range(width)) for i in range(len(x))] + [0.0] * tox._PAD
            for _ in range(rank):
                top = max(values, default=-math.inf)
                values = [v for v in values if v <= top - 1e-3]
            pooled.append(max(0.0, max(values, default=-math.inf) + float(net.w[f"b{width}.{rank}"][f])))
    votes = [0.01] + [0.0] * (len(tox.LANGUAGES) - 1)
    lists = [set(line.split()) for line in tox.FUNCTION_WORDS.values()]
    for word in own:
        held = [k for k, line in enumerate(lists, 1) if word in line]
        for k in held:
            votes[k] += 1 / len(held)
    logit = float(np.array(pooled) @ net.w["o"]) + float(np.ravel(net.w["o0"])[0])
    return 1 / (1 + math.exp(-(logit - net.shift[votes.index(max(votes))])))


@pytest.fixture(scope="module")
def net():
    rng = np.random.default_rng(4)
    some = lambda *shape: rng.normal(0, 0.4, shape).astype(np.float32)
    own = {"table": some(tox.SLOTS, tox.DIM), "o": some(len(tox.POOLS) * tox.FILTERS), "o0": np.float32(0.1)}
    own |= {f"f{k}": some(k, tox.DIM, tox.FILTERS) for k in tox.WIDTHS} | {f"b{k}.{r}": some(tox.FILTERS) for k, r in tox.POOLS}
    return tox.Net(own, shift=np.linspace(-1, 1, len(tox.LANGUAGES)))


def test_scores_are_those_of_plain_loops(net):
    rng = random.Random(3)
    bits = ["the", "THE", "der", "(und)", "les", "y", "idiot!", "Ärger", "straße", "a", "...", "x" * 40, "word,", '"Quote"', "漢字", "não", "one", "two"]
    texts = ["", " ", "the", "idiot! idiot!"] + [" ".join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(20)]
    together = net.score(*tox.slots(pa.array(texts)))
    for text, score in zip(texts, together, strict=True):
        assert score == pytest.approx(plain_score(net, text), abs=2e-3), text
