"""The pipeline's stages on their own input, against brute force."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from foldmark.llm import mixing, quality, token_files
from llm_help import docs, noise

FOLDER = "/root/testdata/sf0.001"


def test_stages_hand_on_documents_and_the_last_reads_files(spark):
    d = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("score", F.lit(1)).withColumns({c: F.lit("clash") for c in ("key", "__key", "__id", "__gone", "__who", "__bad", "__quality")})
    before = d.count()
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, d, FOLDER)
        assert out.columns == d.columns, name
        d = spark.createDataFrame(out.collect(), out.schema)
        assert 0 < d.count() <= before * 2
    last = pipeline.STAGES[-1][1](spark, d, FOLDER)
    assert last.count() == d.count() and last.agg(F.sum("n_tokens")).first()[0] == last.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0]


def test_quality_stage_keeps_what_it_scores_well(spark):
    d = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    want = {r.doc_id for r in quality.score_quality(d, quality.fit_quality(d, labels)).where(F.col("score") >= 0.7).collect()}
    assert {r.doc_id for r in pipeline.keep_quality(spark, d, FOLDER).collect()} == want


def test_one_of_each_group_stays(spark):
    rng = random.Random(3)
    a, b = noise(rng, 100), noise(rng, 100)
    rows = [(5, a), (3, a), (9, a + " x"), (3, a), (1, b), (7, None), (8, None), (None, b), (4, ""), (6, "")]
    got = [(r.doc_id, r.text) for r in pipeline.drop_near_duplicates(spark, docs(spark, rows), FOLDER).collect()]
    assert sorted(got, key=repr) == sorted([(3, a), (1, b), (7, None), (8, None), (4, "")], key=repr)


def test_unrelated_texts_stay_under_null_and_repeated_ids(spark):
    rng = random.Random(4)
    a, b, c, d = (noise(rng, 100) for _ in range(4))
    rows = [(None, a), (None, b), (None, b + " x"), (7, c), (7, d), (7, c), (None, None)]
    got = [(r.doc_id, r.text) for r in pipeline.drop_near_duplicates(spark, docs(spark, rows), FOLDER).collect()]
    assert len(got) == 5 and {(None, a), (7, c), (7, d), (None, None)} < set(got) and len({(None, b), (None, b + " x")} & set(got)) == 1


def test_decontamination_stage(spark, tmp_path):
    rng = random.Random(3)
    item = noise(rng, 30)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, noise(rng, 50) + " " + item), (2, noise(rng, 50)), (None, item), (None, "other"), (3, None)]
    got = [r.doc_id for r in pipeline.decontaminate(spark, docs(spark, rows), str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted([2, 3, None], key=repr)


def test_empty_tables(spark, tmp_path):
    d = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, d, FOLDER).count() == 0


def test_stages_can_be_chained_without_writing_between(spark):
    """No stage deletes what another one's lazy result still reads; two runs do not see each other."""
    d = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first, again = d, d
    for _, stage in pipeline.STAGES[:3]:
        first, again = stage(spark, first, FOLDER), stage(spark, again, FOLDER)
    a, b = ([r.doc_id for r in x.orderBy("doc_id").collect()] for x in (first, again))
    assert a == b and len(a) > 50
    twice = pipeline.drop_near_duplicates(spark, pipeline.drop_near_duplicates(spark, d, FOLDER), FOLDER)
    assert twice.count() > 50


def brute_mixture(rows, share, epochs):
    """Tokens of each leaf and how often each document is drawn, in plain Python."""
    import hashlib
    import re
    from collections import defaultdict

    leaves, weights = defaultdict(list), mixing.WEIGHTS
    for r in rows:
        digits = re.search(r"([0-9]{1,9})$", r.source or "none")
        domain = f"d{int(digits[1]) % 3}" if digits else "none"
        text = r.text or ""
        leaves[domain, r.lang or "none", r.source or "none"].append((r, len(re.findall(r"[^\x20\x09-\x0D]+", text)), hashlib.md5(text.encode()).hexdigest()))
    size = {leaf: sum(n for _, n, _ in own) for leaf, own in leaves.items() if sum(n for _, n, _ in own)}
    given = {(): min(sum(size.values()) * epochs, share * sum(size.values()))}
    for depth, level in enumerate(mixing.LEVELS, 1):
        new = {}
        for parent, budget in given.items():
            room = defaultdict(float)
            for leaf, n in size.items():
                if leaf[: depth - 1] == parent:
                    room[leaf[:depth]] += n * epochs
            open_, left = dict(room), budget
            while open_:  # whoever is full goes, and leaves the rest to its siblings
                total = sum(weights[level].get(k[-1], 1.0) for k in open_)
                full = [k for k in open_ if open_[k] <= left * weights[level].get(k[-1], 1.0) / total + 1e-9]
                if not full:
                    new |= {k: left * weights[level].get(k[-1], 1.0) / total for k in open_}
                    break
                for k in full:
                    new[k] = open_.pop(k)
                    left -= new[k]
        given = new
    drawn = []
    for leaf, budget in given.items():
        budget = int(budget + 1e-6)
        whole, rest = divmod(budget, size[leaf])
        key = lambda x: int(hashlib.md5(f"{mixing.SEED}:{whole}:{'' if x[0].doc_id is None else x[0].doc_id}:{x[2]}".encode()).hexdigest()[:15], 16)  # noqa: B023, E731
        upto = 0
        for x in sorted(leaves[leaf], key=key):
            upto += x[1]
            drawn += [x[0]] * (whole + (rest > 0 and upto <= rest))
    return drawn


def test_mixing_stage_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(k, noise(rng, rng.randint(1, 60)), rng.choice(["en", "de"]), rng.choice(["src0", "src0", "src0", "src1", "src5", "odd"]), 0) for k in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = sorted(r.doc_id for r in brute_mixture(d.collect(), pipeline.MIXTURE_SHARE, pipeline.MIXTURE_EPOCHS))
    assert sorted(r.doc_id for r in pipeline.mix_sources(spark, d, FOLDER).collect()) == want and len(want) > 300


def test_token_stage_against_the_tokenizer(spark):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_files.default_vocabulary())
    d = spark.read.parquet(f"{FOLDER}/documents.parquet")
    start, want = 0, []
    for r in d.orderBy("doc_id").collect():
        ids = [*t.encode(r.text, add_special_tokens=False).ids, 0]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, pipeline.tokenize(spark, d, FOLDER).collect())) == want


def test_run_is_its_stages_in_turn(spark):
    """The whole pipeline over the smallest tables: each stage's own rule holds of what came out of it."""
    d = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in pipeline.STAGES:
        d = spark.createDataFrame(stage(spark, d, FOLDER).collect(), None if d.isEmpty() else stage(spark, d, FOLDER).schema)
    got = pipeline.run(spark, FOLDER)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in d.collect()) and got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
