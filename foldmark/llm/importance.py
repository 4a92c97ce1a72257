"""Importance resampling towards a target: documents drawn by how much likelier their runs of words are there.

1. The words of a block of texts become a trie: a node for every run of one to three words that starts in the
   block. A node holds how often its run occurs and the CRC-32 of the run's text; a child's CRC goes on from its
   parent's, so no run is ever put together as a string. A task keeps one trie of about ``BLOCK`` words at a time and
   adds its nodes' counts up by bucket (CRC modulo ``BUCKETS``); Spark adds up the buckets of all tasks.
2. The driver turns the two tables of ``BUCKETS`` totals into gains, in whole thousandths, and broadcasts them.
3. The same tries, with the gains of their buckets at the nodes, score the documents: the weight of a document is
   the sum of the gains along the paths that start at its words.
4. A document's score is its weight and a Gumbel draw of its id, so that the highest scores are a sample without
   replacement. Only the documents over a quantile that lies surely below the last one drawn are sorted: in ranges,
   with a count of each, so no task sees them all.

Defined results: a null or empty text has no words, no features and weight 0; a long text is read whole, in blocks
that look two words ahead; equal rows are documents of their own and get ranks of their own; a null doc_id is hashed as
empty text and is drawn after equal scores with an id. Without target texts or without documents the totals are 0.
Other columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmark.llm.common import column_or_null, map_arrow, pieces, written
from foldmark.llm.words import Words, words_of

BUCKETS, RUN, MIN_WORDS, PERCENT, BLOCK = 10_000, 3, 20, 5, 1 << 18
SLICE_ROWS = 100_000  # of a range of the drawn documents that one task sorts

#: Bytes between words, once A to Z are lower case: all of ASCII but digits and small letters.
_BREAK = np.ones(256, bool)
_BREAK[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def features_of(n_words: int) -> int:
    return sum(max(0, n_words - k) for k in range(RUN))


def _encoded(keys: np.ndarray | pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of each key's value, and the values."""
    found = (pa.array(keys) if isinstance(keys, np.ndarray) else keys).dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def _tables(images: np.ndarray) -> np.ndarray:
    """What each byte of a 32-bit state becomes under the linear map that sends its bits to ``images``."""
    byte = np.arange(256)
    out = np.zeros((4, 256), np.uint32)
    for bit in range(32):
        out[bit // 8] ^= np.where(byte >> bit % 8 & 1, images[bit], 0).astype(np.uint32)
    return out


def _through(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    return tables[0][state & 255] ^ tables[1][state >> 8 & 255] ^ tables[2][state >> 16 & 255] ^ tables[3][state >> 24]


@lru_cache(maxsize=1024)
def _past(n: int) -> np.ndarray:
    """Tables that take a CRC-32 over ``n`` more bytes; the CRC of these bytes alone is then added bit by bit."""
    if n == 1:
        state = np.uint32(1) << np.arange(32, dtype=np.uint32)
        for _ in range(8):
            state = state >> 1 ^ np.where(state & 1, np.uint32(0xEDB88320), np.uint32(0))
        return _tables(state)
    half = _past(n // 2)
    images = _through(half, _through(half, np.uint32(1) << np.arange(32, dtype=np.uint32)))
    return _tables(_through(_past(1), images) if n % 2 else images)


class WordTrie:
    """All runs of one to :data:`RUN` words that start at words ``begin`` to ``end`` of ``words``.

    ``count[k]`` and ``state[k]`` hold, for the nodes of depth k + 1, how often their run occurs and its CRC-32;
    ``path[k]`` has the node of depth k + 1 that each start leads to, -1 where its text ends before. ``stop`` holds
    for each word one past the last word of its text.
    """

    def __init__(self, words: Words, stop: np.ndarray, begin: int, end: int):
        ahead = min(end + RUN - 1, len(words.starts))
        starts, ends = words.starts[begin:ahead], words.ends[begin:ahead]
        # the words' bytes without what stands between them
        body = words.data[starts[0] : ends[-1]] if len(starts) else words.data[:0]
        ids, spelled = _encoded(_spelled(body[~_BREAK[body]], ends - starts))
        spelled = spelled.to_pylist()
        after = np.fromiter((zlib.crc32(b" " + w) for w in spelled), np.uint32, len(spelled))
        length = np.fromiter(map(len, spelled), np.int64, len(spelled)) + 1
        # words that follow in the same text
        left = stop[begin:end] - np.arange(begin, end)
        n = end - begin
        self.count, self.state, self.path = [], [], []
        node, state = ids[:n].astype(np.int64), np.fromiter(map(zlib.crc32, spelled), np.uint32, len(spelled))
        for depth in range(RUN):
            if depth:
                inside = np.flatnonzero(left > depth)
                key = node[inside] * len(spelled) + ids[inside + depth]
                at, keys = _encoded(key)
                keys = keys.to_numpy(zero_copy_only=False)
                parents, last = keys // max(1, len(spelled)), keys % max(1, len(spelled))
                state = state[parents]
                for size in np.unique(length[last]):  # a blank and a word follow; words of one length are one step
                    own = length[last] == size
                    state[own] = _through(_past(int(size)), state[own])
                state ^= after[last]
                node = np.full(n, -1, np.int64)
                node[inside] = at
            self.path.append(node)
            self.count.append(np.bincount(node[node >= 0], minlength=len(state)))
            self.state.append(state.astype(np.int64))

    def totals(self, buckets: int) -> np.ndarray:
        """Occurrences by bucket."""
        out = np.zeros(buckets, np.int64)
        for count, state in zip(self.count, self.state, strict=True):
            np.add.at(out, state % buckets, count)
        return out

    def weights(self, gains: np.ndarray) -> np.ndarray:
        """For each start the sum of the gains along its path."""
        out = np.zeros(len(self.path[0]), np.int64)
        for state, node in zip(self.state, self.path, strict=True):
            held = node >= 0
            out[held] += gains[state % len(gains)][node[held]]
        return out


def _spelled(letters: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))])


def _tries(words: Words, block: int) -> Iterator[tuple[int, int, WordTrie]]:
    stop = np.repeat(words.first[1:], words.n)
    for begin in range(0, len(words.starts), block):
        end = min(begin + block, len(words.starts))
        yield begin, end, WordTrie(words, stop, begin, end)


def _words(texts: pa.Array) -> Words:
    return words_of(texts, _BREAK, _LOWER)


def bucket_totals(texts: DataFrame, buckets: int = BUCKETS, block: int = BLOCK) -> np.ndarray:
    """How many runs of all of ``texts`` (text) fall in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for piece in pieces(batches):
            for _, _, trie in _tries(_words(piece.column(0)), block):
                total += trie.totals(buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    rows = map_arrow(texts.select(column_or_null(texts, "text", T.StringType()).alias("text")), run, "bucket int, n long")
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row for each bucket
        out[r.bucket] = r.n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 * ln)`` of how much likelier each bucket is in the target, one added to every bucket."""
    s_all, t_all = float(own.sum() + len(own)), float(target.sum() + len(own))
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all))) for s, t in zip(own.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_words, weight`` of every row of ``docs`` (doc_id, text), lazy."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)  # 80 kB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            words = _words(piece.column(1))
            upto = np.zeros(len(words.starts) + 1, np.int64)
            for begin, end, trie in _tries(words, block):
                upto[begin + 1 : end + 1] = trie.weights(sent.value)
            upto = np.cumsum(upto)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(words.n, pa.int64()), pa.array(upto[words.first[1:]] - upto[words.first[:-1]])], ["doc_id", "n_words", "weight"])

    rows = docs.select(column_or_null(docs, "doc_id", T.LongType()).alias("doc_id"), column_or_null(docs, "text", T.StringType()).alias("text"))
    return map_arrow(rows, run, "doc_id long, n_words long, weight long")


def gumbel(doc_id: Column, seed: int = 42) -> Column:
    """A Gumbel draw in whole thousandths, by the id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000.0)


def drawn(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` (doc_id, n_words, score, salt; a written table) with ``rank``: 1, 2, 3 ... of the ``percent`` highest
    scores among the rows of at least ``min_words`` words, null for all others."""
    may = F.col("n_words") >= min_words
    n = scored.where(may).count()
    k = percent * n // 100
    low = None
    if k:
        # a value below the k-th highest for sure: the quantile is off by a ten-thousandth of the rows at most
        low = scored.where(may).agg(F.percentile_approx("score", max(0.0, 1 - percent / 100 - 0.001), 10_000)).first()[0]
        if scored.where(may & (F.col("score") >= low)).count() < k:
            low = None
    top = may & (F.lit(k > 0) if low is None else F.col("score") >= low)
    rest = scored.where(~F.coalesce(top, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    if not k:
        return rest
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("salt")]
    best = scored.where(top)
    slices = best.count() // SLICE_ROWS + 1
    # an id made of the number of the range and the place in it
    best = written(best.repartitionByRange(slices, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "drawn")
    slice_of = F.shiftright("place", 33).cast("int")
    before, offsets = 0, []
    for r in best.groupBy(slice_of.alias("slice")).count().orderBy("slice").collect():  # a row for each range
        offsets.append((r["slice"], before))
        before += r["count"]
    spark = scored.sparkSession
    starts = F.broadcast(spark.createDataFrame(offsets, "slice int, before long"))
    place = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    ranked = best.withColumn("slice", slice_of).join(starts, "slice").withColumn("rank", F.when(place <= k, place))
    return rest.unionByName(ranked.select(*rest.columns))


def importance(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = 42) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs`` for the texts of ``target``."""
    gain = gains(bucket_totals(docs), bucket_totals(target))
    # the salt deals out rows that are equal in everything; it is written with them, so it stays
    rows = weighed(docs, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)).withColumn("salt", F.rand(seed))
    found = drawn(written(rows, "weighed"), percent, min_words)
    n = F.col("n_words")
    return found.select("doc_id", (F.greatest(n, F.lit(0)) + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))).alias("n_features"), "weight", "score", "rank")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _sql() -> str:
    """Every different run spelled out, its CRC-32 by halves of bytes, and plain sums and ranks."""
    table = []
    for k in range(16):
        for _ in range(4):
            k = k >> 1 ^ (0xEDB88320 if k & 1 else 0)
        table.append(k)
    digit = lambda at: f"instr('123456789ABCDEF', substr(h, {at}, 1))"
    octets = f"list_transform(range(len(h) // 2), lambda i: 16 * {digit('CAST(2 * i + 1 AS BIGINT)')} + {digit('CAST(2 * i + 2 AS BIGINT)')})"
    half = lambda c, b: f"xor({c} >> 4, {table}[CAST((xor({c}, {b}) & 15) + 1 AS BIGINT)])"
    first = half("c", "b")
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform({octets}, lambda x: x::BIGINT)), lambda c, b: {half(f'({first})', '(b >> 4)')}), 4294967295)"
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    runs = "w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents), b AS (SELECT {words} AS w FROM benchmark),
df AS MATERIALIZED (SELECT rid, unnest({runs}) AS f FROM d), bf AS (SELECT unnest({runs}) AS f FROM b), names AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf)),
k AS MATERIALIZED (SELECT f, {crc} % {BUCKETS} AS bucket FROM names),
s AS (SELECT bucket, count(*) AS s FROM df JOIN k USING (f) GROUP BY 1), t AS (SELECT bucket, count(*) AS t FROM bf JOIN k USING (f) GROUP BY 1),
n AS (SELECT (SELECT count(*) FROM df)::DOUBLE AS s_all, (SELECT count(*) FROM bf)::DOUBLE AS t_all),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + {BUCKETS}) / ((s + 1)::DOUBLE * (t_all + {BUCKETS}))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), n),
weight AS (SELECT rid, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM df JOIN k USING (f) JOIN gain USING (bucket) GROUP BY 1),
x AS (SELECT rid, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN weight USING (rid)),
r AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM x WHERE n_words >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {PERCENT} * (SELECT count(*) FROM r) // 100 THEN rank END AS rank FROM x LEFT JOIN r USING (rid)"""


OP11_SQL = _sql()
