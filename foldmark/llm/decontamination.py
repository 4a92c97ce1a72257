"""Benchmark decontamination by greedy string tiling.

1. Seeds: every window of ``MIN_MATCH`` words of the test items (folded, without the marks at their
   ends) is hashed by Karp-Rabin. Items are a stated query set: they are broadcast in blocks of at
   most ``BLOCK`` words, one scan of the documents each, and documents probe a block with every window.
   An item of fewer words is one seed, all its words; it is contaminated by each document that has them in a row.
2. Where seeds of an item that a document shares could cover enough of it, the pair is tiled: the longest
   match of unmarked words is marked in both again and again, until none of ``MIN_MATCH`` is left.
3. A document is contaminated by an item of which the tiles cover ``COVERAGE`` or more. Tiles may lie
   anywhere, so a passage whose sentences were put in another order is caught as well.

No row is shuffled. Where an item and a document share seeds in more than ``PAIRS`` pairs of places (a word said over and
over in both), the longest matches are looked for word by word instead, in memory in proportion to the text.

Defined results: null or empty texts match nothing; repeated documents each give their rows, repeated items too; a null
id of a document or an item is null in its rows; very long texts are read whole; an empty table gives an empty result;
columns beside the ids and texts, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmark.llm.common import column_or_null, map_arrow, pieces
from foldmark.llm.quality import with_text
from foldmark.llm.words import rolling, valid, words_of

MIN_MATCH, COVERAGE, BLOCK, PAIRS = 5, 0.6, 1 << 20, 1 << 21


@dataclass
class Seeds:
    """A block of items: their words, and the places of each seed hash in order of it."""

    ids: pa.Array
    first: np.ndarray
    words: np.ndarray
    hashes: np.ndarray
    places: np.ndarray
    filter: np.ndarray
    short: list[tuple[int, np.ndarray, np.ndarray]]  # number of words, hashes of the items that have so many, their places

    @classmethod
    def of(cls, ids: list[int | None], texts: list[str | None]) -> Seeds:
        items = words_of(pa.array(texts, pa.string())).trimmed()
        words = items.hashes(lower=True)
        places = np.flatnonzero(valid(items.first, MIN_MATCH))
        hashes = rolling(words, MIN_MATCH)[places]
        order = np.argsort(hashes, kind="stable")
        low = np.zeros(1 << 22, bool)
        low[hashes & np.uint64((1 << 22) - 1)] = True
        short = []
        for size in np.unique(items.n[(items.n > 0) & (items.n < MIN_MATCH)]).tolist():
            own = np.flatnonzero(items.n == size)
            whole = rolling(words, size)[items.first[own]]
            by = np.argsort(whole, kind="stable")
            short.append((size, whole[by], own[by]))
        return cls(pa.array(ids, pa.int64()), items.first, words, hashes[order], places[order], low, short)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places in ``hashes`` of the block's seeds."""
        maybe = np.flatnonzero(self.filter[hashes & np.uint64((1 << 22) - 1)])
        if not len(maybe) or not len(self.hashes):
            return maybe[:0]
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        return maybe[self.hashes[at] == hashes[maybe]]


def tile(item: np.ndarray, text: np.ndarray, pairs: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(place in item, place in text, length)``; ``pairs`` has the places of their shared seeds."""
    diagonal = pairs[:, 1] - pairs[:, 0]
    order = np.lexsort((pairs[:, 0], diagonal))
    a, d = pairs[order, 0], diagonal[order]
    new = np.ones(len(a), bool)
    new[1:] = (d[1:] != d[:-1]) | (a[1:] != a[:-1] + 1)  # consecutive seeds of a diagonal make one match
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(a))) + least - 1
    heap = [(-int(n), int(x), int(x + k)) for n, x, k in zip(size, a[begin], d[begin], strict=True)]
    heapq.heapify(heap)
    in_item, in_text, tiles = np.zeros(len(item), bool), np.zeros(len(text), bool), []
    while heap:
        n, x, y = heapq.heappop(heap)
        free = ~(in_item[x : x - n] | in_text[y : y - n])
        if free.all():
            in_item[x : x - n] = in_text[y : y - n] = True
            tiles.append((x, y, -n))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], free.view(np.int8), [0]])))
        for s, e in zip(edge[::2], edge[1::2], strict=True):
            if e - s >= least:
                heapq.heappush(heap, (int(s - e), x + int(s), y + int(s)))
    return tiles


def tile_dense(item: np.ndarray, text: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """The tiles of :func:`tile` without a list of pairs: lengths of matches from each place on, row by row of the item."""
    in_item, free, tiles = np.zeros(len(item), bool), np.ones(len(text), bool), []
    while True:
        best, run = (0, 0, 0), np.zeros(len(text) + 1, np.int32)
        for x in range(len(item) - 1, -1, -1):
            # the match from (x, y) on is one longer than that from (x + 1, y + 1) on
            run = np.append(np.where(free & (text == item[x]), run[1:] + 1, 0), 0).astype(np.int32) if not in_item[x] else np.zeros(len(text) + 1, np.int32)
            y = int(run.argmax())
            best = max(best, (int(run[y]), -x, -y))
        n, x, y = best[0], -best[1], -best[2]
        if n < least:
            return tiles
        in_item[x : x + n], free[y : y + n] = True, False
        tiles.append((x, y, n))


def matches(seeds: Seeds, texts: pa.Array, coverage: float) -> Iterator[tuple[int, int, float, int]]:
    """``(text, item, coverage, number of tiles)`` of the pairs that reach ``coverage``."""
    docs = words_of(texts).trimmed()
    words = docs.hashes(lower=True)
    for size, whole, own in seeds.short:
        windows = rolling(words, size)
        at = np.flatnonzero(np.isin(windows, whole))
        at = at[valid(docs.first, size)[at]]
        doc = np.searchsorted(docs.first, at, "right") - 1
        left, right = np.searchsorted(whole, windows[at], "left"), np.searchsorted(whole, windows[at], "right")
        for k, i in sorted({(int(d), int(i)) for d, x, y in zip(doc, left, right, strict=True) for i in own[x:y]}):
            yield k, i, 1.0, 1
    hashes = rolling(words, MIN_MATCH)
    found = seeds.find(hashes)
    if not len(found):
        return
    found = found[valid(docs.first, MIN_MATCH)[found]]
    doc = np.searchsorted(docs.first, found, "right") - 1
    for k in np.unique(doc):
        own = found[doc == k]
        order = np.argsort(hashes[own], kind="stable")
        there, here = hashes[own][order], own[order] - docs.first[k]
        # places of the items' words that begin a seed which the document holds
        once = np.unique(there)
        left, right = np.searchsorted(seeds.hashes, once, "left"), np.searchsorted(seeds.hashes, once, "right")
        at = np.repeat(left, right - left) + np.arange((right - left).sum()) - np.repeat(np.cumsum(right - left) - (right - left), right - left)
        item = np.searchsorted(seeds.first, seeds.places[at], "right") - 1
        for i in np.unique(item):
            places, wanted = seeds.places[at[item == i]] - seeds.first[i], seeds.hashes[at[item == i]]
            size = int(seeds.first[i + 1] - seeds.first[i])
            covered = np.zeros(size + MIN_MATCH, np.int64)
            covered[places] += 1
            covered[places + MIN_MATCH] -= 1
            if (np.cumsum(covered)[:size] > 0).sum() < coverage * size:
                continue  # even overlapping seeds cover too little
            first, last = np.searchsorted(there, wanted, "left"), np.searchsorted(there, wanted, "right")
            n = last - first
            one, two = seeds.words[seeds.first[i] : seeds.first[i + 1]], words[docs.first[k] : docs.first[k + 1]]
            if n.sum() > PAIRS:
                tiles = tile_dense(one, two)
            else:
                y = here[np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                tiles = tile(one, two, np.stack([np.repeat(places, n), y], 1))
            share = sum(t[2] for t in tiles) / size
            if share >= coverage:
                yield int(k), int(i), share, len(tiles)


_RESULT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("n_tiles", pa.int64())])


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block: int = BLOCK) -> DataFrame:
    """``doc_id, item_id, coverage, n_tiles`` of each document and each test item that it gives away."""
    spark = docs.sparkSession
    items = benchmark.select(column_or_null(benchmark, "item_id", T.LongType()).alias("item_id"), column_or_null(benchmark, "text", T.StringType()).alias("text"))
    total = items.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0] or 0
    n_blocks = max(1, -(-2 * total // block))
    docs = with_text(docs)
    out = None
    for b in range(n_blocks):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == b).orderBy("item_id", "text").collect()
        sent = spark.sparkContext.broadcast(Seeds.of([r.item_id for r in own], [r.text for r in own]))  # about `block` words at most

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            seeds = sent.value
            for batch in pieces(batches):
                rows = list(matches(seeds, batch.column(1), coverage))
                ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                items = seeds.ids.take(pa.array([r[1] for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, items, pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.int64())], schema=_RESULT)

        part = map_arrow(docs, run, "doc_id long, item_id long, coverage double, n_tiles long")
        out = part if out is None else out.unionByName(part)
    return out


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
