"""Substring dedup with fixed-block anchors.

A word goes if it lies in a window of ``WINDOW`` words that also starts somewhere else. Any such window
holds one of its document's non-overlapping blocks of ``BLOCK = (WINDOW + 1) / 2`` words, so:

1. Index and probes: every document gives the hashes of its non-overlapping blocks (the index) and of
   every rolling window of a block's length (the probes). Spark deals them by range of hash; a task
   finds the index entries that were probed from elsewhere, and tells the parts they came from.
2. Extension: around each block that was found, a document extends to the windows of ``WINDOW`` words over
   it, and those are counted by their 64-bit hash. Two windows that start in different places with one
   hash are repeats; overlapping ones make up the maximal repeat, and its words go.

Documents without a block that was found are done after step 1 and their texts move once; the others
move once more. Documents belong to *parts* (of about a megabyte, by a hash of id and text), and what is
asked and answered is made distinct per part: a passage in a third of all documents is a few entries a
part. Entries travel as sorted arrays, a row for each range of hashes, so the shuffle has no row per word.

Defined results: a null or empty text has no words; the digest of nothing kept is that of the empty
string; repeated rows are copies of each other (each loses what is repeated); texts shorter than a
window lose nothing; a very long text is cut whole; columns beside ``doc_id`` and ``text``, whatever their
names, are ignored; an empty table gives an empty result. Windows are told apart by 64 bits: among n different
windows the chance that any two are taken for one is about n * n / 2**65 (one in 40 for 10**9 of them).
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.llm.common import map_arrow, pieces, written
from foldmark.llm.quality import with_text
from foldmark.llm.words import Words, rolling, valid, words_of

WINDOW = 35
_FLUSH = 1 << 22
_NARROW = 40  # bits of an entry behind those that name its range

_ENTRIES = pa.schema([("range", pa.int64()), ("first", pa.int64()), ("steps", pa.binary()), ("refs", pa.binary())])
_ANSWERS = pa.schema([("part", pa.int64()), ("keys", pa.binary())])
_OUT = pa.schema([*_ENTRIES, ("part", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string())])


class Ranges:
    """Cuts hashes into keys and ranges: ``bits`` name the range, ``width`` is the length of a key."""

    def __init__(self, bits: int, wide: bool):
        self.bits, self.wide = bits, wide
        self.width = 64 if wide else _NARROW + bits
        self.step = np.uint64 if wide else np.uint32

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - self.width)

    def pack(self, keys: np.ndarray, parts: np.ndarray, index: np.ndarray) -> pa.RecordBatch:
        """Rows of entries: distinct (key, part) in order, with a mark for the index and one for several places."""
        order = np.lexsort((parts, keys))
        keys, parts, index = keys[order], parts[order], index[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (parts[1:] != parts[:-1])
        begin = np.flatnonzero(new)
        several = np.diff(np.append(begin, len(keys))) > 1
        marked = np.logical_or.reduceat(index, begin) if len(begin) else index
        keys = keys[begin]
        refs = (parts[begin].astype(np.uint64) << np.uint64(2)) | (several.astype(np.uint64) << np.uint64(1)) | marked.astype(np.uint64)
        refs = refs.astype(np.uint16 if not len(refs) or refs.max() < 1 << 16 else np.uint64)
        of = self.range_of(keys)
        steps = np.diff(keys, prepend=keys[:1])
        cut = np.flatnonzero((np.diff(of, prepend=of[:1]) != 0) | (steps > np.iinfo(self.step).max))
        edges = np.concatenate([[0], cut[cut > 0], [len(keys)]]) if len(keys) else np.zeros(1, int)
        rows: list[list] = [[], [], [], []]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            small = steps[a:b].astype(self.step)
            small[0] = 0
            for column, value in zip(rows, (int(of[a]), int(keys[a].view(np.int64)), small.tobytes(), refs[a:b].tobytes()), strict=True):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, _ENTRIES, strict=True)], schema=_ENTRIES)

    def range_of(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(self.width - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)

    def unpack(self, first: int, steps: bytes, refs: bytes) -> tuple[np.ndarray, np.ndarray]:
        small = np.frombuffer(steps, self.step).astype(np.uint64)
        keys = np.array([first], np.int64).view(np.uint64) + np.cumsum(small, dtype=np.uint64)
        return keys, np.frombuffer(refs, np.uint16 if len(refs) == 2 * len(small) else np.uint64).astype(np.uint64)


class _Asked:
    """Entries of a task until there are enough for full rows."""

    def __init__(self, ranges: Ranges):
        self.ranges, self.held, self.n = ranges, [], 0

    def add(self, keys: np.ndarray, parts: np.ndarray, index: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((keys, parts, index))
        self.n += len(keys)
        if self.n >= _FLUSH:
            yield self.out()

    def out(self) -> pa.RecordBatch:
        batch = self.ranges.pack(*(np.concatenate(x) for x in zip(*self.held, strict=True)))
        self.held, self.n = [], 0
        return batch


def _dealt(rows: DataFrame, by: str, size: int) -> DataFrame:
    """``rows`` dealt by a column, into more partitions than the session asks for where ``size`` bytes of text need them."""
    many = size >> 27
    return rows.repartition(many, by) if many > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows.repartition(by)


def _answers(entries: DataFrame, ranges: Ranges, size: int) -> DataFrame:
    """``part, keys``: the index entries of several places, for each part that asked."""

    def found(rows: list[tuple[int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        keys, refs = (np.concatenate(x) for x in zip(*(ranges.unpack(*r) for r in rows), strict=True))
        order = np.argsort(keys, kind="stable")
        keys, refs = keys[order], refs[order]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        times = np.diff(np.append(begin, len(keys)))
        several = (times > 1) | (np.bitwise_or.reduceat(refs, begin) & np.uint64(2)).astype(bool)
        good = np.repeat(several & (np.bitwise_or.reduceat(refs, begin) & np.uint64(1)).astype(bool), times)
        keys, parts = keys[good], (refs[good] >> np.uint64(2)).astype(np.int64)
        order = np.argsort(parts, kind="stable")
        keys, parts = keys[order], parts[order]
        begin = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else parts[:0]
        ends = np.append(begin, len(parts))
        yield pa.RecordBatch.from_arrays([pa.array(parts[begin]), pa.array([np.unique(keys[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())], schema=_ANSWERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            for number, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != at and held:
                    yield from found(held)
                    held = []
                at = number
                held.append(row)
        if held:
            yield from found(held)

    return map_arrow(_dealt(entries.select("range", "first", "steps", "refs"), "range", size).sortWithinPartitions("range"), run, "part long, keys binary")


def _beside(docs: DataFrame, answers: DataFrame, size: int) -> DataFrame:
    """Documents of a part behind the answers to it, in one task and in order."""
    asked = answers.select("part", F.lit(0).alias("kind"), "keys", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    told = docs.select("part", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("keys"), "doc_id", "text")
    return _dealt(asked.unionByName(told), "part", size).sortWithinPartitions("part", "kind")


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """Documents of one part, its number, and the sorted keys that it was told."""
    at, keys, table = None, [], np.zeros(0, np.uint64)
    for batch in batches:
        parts, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero(np.diff(parts, prepend=parts[:1]) | np.diff(kinds, prepend=kinds[:1]))
        for a, b in zip(np.append([0], edges), np.append(edges, len(parts)), strict=True):
            if a == b:
                continue
            if parts[a] != at:
                at, keys, table = parts[a], [], np.zeros(0, np.uint64)
            if kinds[a] == 0:
                keys += [np.frombuffer(x, np.uint64) for x in batch.column(2).slice(a, b - a).to_pylist()]
                continue
            if keys:
                table, keys = np.unique(np.concatenate(keys)), []
            for piece in pieces([batch.slice(a, b - a)]):
                yield piece, int(at), table


def _among(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table) or not len(keys):
        return np.zeros(len(keys), bool)
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


def _digest(text: str | None, keep: np.ndarray | None = None) -> str:
    words = (text or "").encode().split()
    return hashlib.sha256(b" ".join(words if keep is None else compress(words, keep))).hexdigest()


def _over_blocks(words: Words, hit: np.ndarray, block: int, window: int) -> np.ndarray:
    """Places of windows whose document's own block within them is among ``hit`` (marks of places)."""
    good = valid(words.first, window)
    at = np.flatnonzero(good)
    inside = at - words.first[words.doc()[at]]
    return at[hit[at + (-inside) % block]] if len(at) else at


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and the ``text`` of each of ``docs`` (doc_id, text) where words went."""
    spark, block = docs.sparkSession, (window + 1) // 2
    docs = with_text(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts, bits = max(1, size >> 20), max(0, int(size >> 21).bit_length())
    narrow, wide = Ranges(bits, False), Ranges(bits, True)
    docs = docs.withColumn("part", F.expr(f"pmod(xxhash64(doc_id, text), {n_parts}L)"))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = _Asked(narrow)
        for batch in pieces(batches):
            words = words_of(batch.column(0))
            at = np.flatnonzero(valid(words.first, block))
            doc = words.doc()[at]
            keys = narrow.keys(rolling(words.hashes(), block)[at])
            yield from asked.add(keys, batch.column(1).to_numpy()[doc], (at - words.first[doc]) % block == 0)
        if asked.n:
            yield asked.out()

    entries = map_arrow(docs.select("text", "part"), probe, "range long, first long, steps binary, refs binary")
    blocks = written(_answers(entries, narrow, size), "blocks")
    _release(spark)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = _Asked(wide)
        for batch, part, table in _told(batches):
            texts = batch.column(4)
            words = words_of(texts)
            hashes = words.hashes()
            at = np.flatnonzero(valid(words.first, block))
            hit = np.zeros(len(hashes) + block, bool)
            own = at[(at - words.first[words.doc()[at]]) % block == 0]
            hit[own] = _among(narrow.keys(rolling(hashes, block)[own]), table)
            over = _over_blocks(words, hit, block, window)
            if len(over):
                for packed in asked.add(rolling(hashes, window)[over], np.full(len(over), part, np.int64), np.ones(len(over), bool)):
                    yield _rows(packed)
            waiting = np.zeros(batch.num_rows, bool)
            waiting[words.doc()[over]] = True
            values = [t if w else None for t, w in zip(texts.to_pylist(), waiting, strict=True)]
            done = [None if w else _digest(t) for t, w in zip(texts.to_pylist(), waiting, strict=True)]
            n = batch.num_rows
            yield _rows(pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int64()), batch.column(3), pa.array(words.n, pa.int64()), pa.array([0] * n, pa.int64()), pa.array(done, pa.string()), pa.array(values, pa.string())], list(_OUT.names[4:])))
        if asked.n:
            yield _rows(asked.out())

    step = written(map_arrow(_beside(docs, blocks, size), extend, "range long, first long, steps binary, refs binary, part long, doc_id long, n_words long, n_removed long, kept_sha256 string, text string"), "extended")
    _release(spark)
    repeats = written(_answers(step.where("range IS NOT NULL"), wide, size), "repeats")
    waiting = step.where("range IS NULL AND kept_sha256 IS NULL")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, table in _told(batches):
            texts = batch.column(4)
            words = words_of(texts)
            hashes = words.hashes()
            at = np.flatnonzero(valid(words.first, window))
            again = at[_among(rolling(hashes, window)[at], table)] if len(table) else at[:0]
            edge = np.zeros(len(hashes) + window + 1, np.int64)
            np.add.at(edge, again, 1)
            np.add.at(edge, again + window, -1)
            keep = np.cumsum(edge)[: len(hashes)] == 0
            removed, sums, left = [], [], []
            for k, text in enumerate(texts.to_pylist()):
                own = keep[words.first[k] : words.first[k + 1]]
                removed.append(int(len(own) - own.sum()))
                sums.append(_digest(text, own))
                left.append(b" ".join(compress(text.encode().split(), own)).decode())
            yield pa.RecordBatch.from_arrays([batch.column(3), pa.array(words.n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sums, pa.string()), pa.array(left, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "text"])

    last = map_arrow(_beside(waiting, repeats, size), cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, text string")
    return step.where("range IS NULL AND kept_sha256 IS NOT NULL").select("doc_id", "n_words", "n_removed", "kept_sha256", "text").unionByName(last)


def _rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """``batch`` with all columns of the step's output, missing ones null."""
    return pa.RecordBatch.from_arrays([batch.column(f.name) if f.name in batch.schema.names else pa.nulls(batch.num_rows, f.type) for f in _OUT], schema=_OUT)


def _release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of steps that are written; it acts when the JVM collects garbage.

    What those steps made lies in the shared folder, so nothing that is lost later is computed from these files again."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_removed", "kept_sha256")
