import hashlib
import math

import numpy as np
import pytest

from foldmark.llm import codes
from foldmark.llm.codes import KdTree, op12_vector_codes, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, entry int, size int, most int, v string, code string, part int"


def brute(rows, entries=256, rounds=4):
    """The contract over ``(vec_id, vector, label)`` in Python integers; vectors of one length that four divides."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // 4
    cut = [[v[k * width : (k + 1) * width] for k in range(4)] for _, v, _ in kept]
    lead = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))[:entries]
    books = [[list(cut[r][k]) for r in lead] for k in range(4)]

    def near(k, p):
        return min((sum((a - b) ** 2 for a, b in zip(p, e)), j) for j, e in enumerate(books[k]))

    for _ in range(rounds):
        for k in range(4):
            own = {}
            for c in cut:
                own.setdefault(near(k, c[k])[1], []).append(c[k])
            for j, parts in own.items():
                books[k][j] = [sum(col) // len(parts) for col in zip(*parts)]
    found = [[near(k, c[k]) for k in range(4)] for c in cut]
    errors = {}
    for (_, _, label), f in zip(kept, found):
        errors[label] = errors.get(label, 0) + sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(x) for k in range(4) for e in books[k] for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{j:02x}" for _, j in f), sum(d for d, _ in f), errors[label], digest) for (i, _, label), f in zip(kept, found)), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("entries", [1, 5, 256])
def test_search_visits_boxes_at_equal_distance(entries):
    rng = np.random.default_rng(entries)
    for kind in (np.float64, object):
        book = rng.integers(-3, 4, (entries, 3)).astype(np.int64).astype(kind)  # many equal entries and ties
        x = rng.integers(-4, 5, (300, 3)).astype(np.int64).astype(kind)
        entry, d = KdTree(book).nearest(x)
        all_d = ((x[:, None] - book[None]) ** 2).sum(2).astype(np.int64)
        assert (entry == all_d.argmin(1)).all() and (d.astype(np.int64) == all_d.min(1)).all()


def test_query_is_the_contract(spark):
    df = op12_vector_codes(spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got(df) == brute(rows)


def test_unlike_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=8), 1)], i % 3 or None) for i in range(60)]
    rows += [(7, [0.5] * 8, 1), (7, [0.25] * 8, 1), (None, [0.1] * 8, None), (None, [0.1] * 8, 2), (70, rows[3][1], 0)]
    rows += [(71, None, 1), (72, [1.0] * 7 + [None], 1), (73, [float("nan")] + [0.0] * 7, 1), (74, [float("inf")] + [0.0] * 7, 1)]
    extra = [(i, v, label, 9, 9, 9, "x", "y", 9) for i, v, label in rows]
    df = vector_codes(spark.createDataFrame(extra, SCHEMA), entries=20)
    assert got(df) == brute(rows, 20)
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert got(vector_codes(spark.createDataFrame(extra[:0], SCHEMA))) == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) * 30_000 for x in rng.normal(size=4)], 1) for i in range(40)]
    assert got(vector_codes(spark.createDataFrame([(*r, 0, 0, 0, "", "", 0) for r in rows], SCHEMA), entries=6)) == brute(rows, 6)
    far = [(1, [1e300, 0.0, 0.0, 0.0], 1), (2, [0.0] * 4, 1)]
    assert vector_codes(spark.createDataFrame([(*r, 0, 0, 0, "", "", 0) for r in far], SCHEMA), entries=1).count() == 2


def test_other_lengths_keep_their_rows(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], 1), (2, [1.5, 2.0, 3.0, 4.0, 5.0, 6.0], 1), (3, [1.0], 1), (4, [], None)]
    found = {r.vec_id: r for r in vector_codes(spark.createDataFrame([(*r, 0, 0, 0, "", "", 0) for r in rows], SCHEMA), entries=1).collect()}
    assert found[3].code is None and found[4].error is None and found[4].label_error is None and found[3].label_error is None
    assert found[1].code == found[2].code == "00000000" and found[1].label_error == found[1].error + found[2].error
    # the mean of 1024 and 1536, and what fills up the last part is not printed
    assert found[1].codebooks_sha256 == hashlib.sha256(b"1280,2048,3072,4096,5120,6144").hexdigest()
    empty = vector_codes(spark.createDataFrame([(1, [], 1, 0, 0, 0, "", "", 0)], SCHEMA)).collect()
    assert [(r.code, r.error) for r in empty] == [("00000000", 0)]


def test_sums_are_made_once_a_task(spark):
    whole = codes.written(codes.whole_vectors(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")), "vectors")
    books = codes.fit_codebooks(whole, 16, 1)
    assert len(books.entries) == 4 and len(books.entries[0]) == 16 and books.kind is np.float64
    assert {tuple(t.entries.shape) for t in books.trees()} == {(16, 16)}
