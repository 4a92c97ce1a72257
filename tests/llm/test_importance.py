import hashlib
import math
import re
import zlib

import pytest

from foldmark.llm import importance as im
from foldmark.llm.importance import importance, op11_importance

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, weight string, rank int, n_words int, salt int, score int, place int, slice int"


def runs(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, target):
    """The contract over ``(doc_id, text)`` and texts; rows that are equal share their ranks as a sorted list."""
    own, aim, found = [0] * 10_000, [0] * 10_000, [(i, *runs(t)) for i, t in docs]
    for _, _, buckets in found:
        for b in buckets:
            own[b] += 1
    for t in target:
        for b in runs(t)[1]:
            aim[b] += 1
    s, t = sum(own), sum(aim)
    gain = [math.floor(1000 * math.log((a + 1) * (s + 10_000) / ((o + 1) * (t + 10_000)))) for o, a in zip(own, aim)]
    rows = []
    for i, n, buckets in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        rows.append([i, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n, None])
    may = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(may[: 5 * len(may) // 100]):
        r[5] = k + 1
    return sorted(((*r[:4], r[5]) for r in rows), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_is_the_contract(spark):
    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    df = op11_importance(spark, d)
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"] and got(df) == brute(docs, target)


def test_unlike_rows(spark, monkeypatch):
    monkeypatch.setattr(im, "SLICE_ROWS", 3)  # several ranges
    some = ["one two three four five six seven " * 4, "ÄÖÜ straße Ünïcode 漢字 42 x " * 5, "Tab\there\nand\x00there " * 9]
    docs = [(k, some[k % 3] + str(k % 11)) for k in range(150)]
    docs += [(None, None), (None, some[0]), (None, some[0]), (3, ""), (3, docs[3][1]), (3, docs[3][1]), (900, "word " * 19), (901, "word " * 20), (902, "  \t"), (903, "Abc" * 5000)]
    target = [some[1], None, "", some[1], "one two", "x"]
    rows = spark.createDataFrame([(i, t, "w", 1, 2, 3, 4, 5, 6) for i, t in docs], DOCS)
    aim = spark.createDataFrame([(i, t, "w", 1, 2, 3, 4, 5, 6) for i, t in enumerate(target)], DOCS)
    assert got(importance(rows, aim)) == brute(docs, target)
    assert got(importance(rows.limit(0), aim)) == [] and got(importance(rows, aim.limit(0))) == brute(docs, [])


def test_equal_rows_get_ranks_of_their_own(spark):
    rows = spark.createDataFrame([(1, "a b " * 30, "w", 1, 2, 3, 4, 5, 6)] * 100, DOCS)
    ranks = [r.rank for r in importance(rows, rows).collect()]
    assert sorted(r for r in ranks if r) == [1, 2, 3, 4, 5] and ranks.count(None) == 95


@pytest.mark.parametrize("block", [1, 2, 7, 1000])
def test_blocks_look_ahead(spark, block):
    texts = ["a b c a b c d", "", "a", "a b", "b c a b " * 6]
    df = spark.createDataFrame([(i, t, "w", 1, 2, 3, 4, 5, 6) for i, t in enumerate(texts)], DOCS)
    total = im.bucket_totals(df, 10_000, block)
    want = [0] * 10_000
    for t in texts:
        for b in runs(t)[1]:
            want[b] += 1
    assert total.tolist() == want
    gain = im.gains(total, total[::-1].copy())
    found = {r.doc_id: (r.n_words, r.weight) for r in im.weighed(df, gain, block).collect()}
    assert found == {i: (runs(t)[0], sum(int(gain[b]) for b in runs(t)[1])) for i, t in enumerate(texts)}
