"""Near-duplicates: improved consistent weighted sampling over TF-IDF shingles, banded, verified.

1. Document frequencies of all words are counted over all documents. A shingle is five words (all words
   where there are fewer); its weight is its count in the document times the mean idf of its words.
   ``idf = ln(1 + N / max(df, RARE * N))``, the same rule at every size: a word in fewer than ``RARE`` of the
   documents counts as one in that many. So only the commoner words need a table, and it holds at most (mean
   distinct words) / ``RARE`` entries whatever the corpus - a proven bound, it is broadcast. (The idf of the
   shingle itself would make what a large group of copies has in common light and their edits heavy: the
   copies would no longer be near.)
2. ICWS draws ``BANDS * ROWS`` samples per document; two documents agree in a sample with the
   probability of their weighted Jaccard similarity.
3. Documents that agree in all rows of a band meet in a bucket. Copies of one text were made one row
   before. One document of each bucket, its star, is compared with all others of other classes: never
   all pairs. A second turn takes another star for the buckets that still hold several classes: the
   member nearest to the bucket's consensus of samples where it has many (it finds the text that the others
   were varied from) and the greatest elsewhere; more follow, by hash, while they pay.
4. Whatever is then left of the buckets that hold several classes is joined exactly, without all pairs: texts
   whose similarity is ``SIMILARITY`` or more share a shingle among the rarest of either (prefix filter),
   and the weight from that shingle on bounds what they can have in common. Shingles that the same texts
   share count as one. Pairs of different classes that pass are compared, so no link between members of one
   bucket is lost, however few turns there were.
5. A pair is a link if its exact weighted Jaccard similarity is ``SIMILARITY`` or more. Classes are the
   connected components of the links; a class is named by its least doc_id.

Buckets are only ever aggregated or joined by key, so one with a third of all rows is split by AQE. Ids
of candidates are broadcast up to ``BROADCAST_ROWS`` of them, counted before; beyond, tables are joined.

Defined results: a null text is no copy of anything; empty texts are copies of each other; texts that
differ only in white space have equal shingles; repeated rows are one class; an empty table gives an
empty result; a null doc_id takes part, its own class is named null if nothing else is in it; very long texts
are compared whole; columns beside ``doc_id`` and ``text``, whatever their names, are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.llm.common import BROADCAST_ROWS, counted, dropped, map_arrow, pieces, recorded, written
from foldmark.llm.components import components
from foldmark.llm.quality import with_text
from foldmark.llm.words import Words, mix, rolling, valid, words_of

SHINGLE, SIMILARITY, RARE = 5, 0.8, 1e-3
BANDS, ROWS, MANY = 12, 4, 8
PAYS = 0.05  # share of links among a turn's pairs that makes another turn cheaper than the exact join
SLOTS = 1 << 16  # of the table that orders shingles by how many texts hold them; broadcast
_FLUSH = 1 << 22

_rng = np.random.default_rng(97)
_U = (np.arange(4096) + 0.5) / 4096


def _gamma_quantiles() -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution is 1 - (1 + x) exp(-x)."""
    x = np.linspace(1e-4, 25, 400_000)
    return np.interp(_U, 1 - (1 + x) * np.exp(-x), x)


_GAMMA = _gamma_quantiles().astype(np.float32)
_INVERSE, _LOG = (1 / _GAMMA).astype(np.float32), np.log(_GAMMA).astype(np.float32)
_SEEDS = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


class Idf:
    """``ln(1 + N / max(df, RARE * N))`` of a word hash; one that is not in the table is in one document or few."""

    def __init__(self, words: np.ndarray, df: np.ndarray, n_docs: int):
        order = np.argsort(words)
        self.words = words[order]
        self.most = np.float32(np.log1p(min(max(1, n_docs), 1 / RARE)))
        self.value = np.log1p(n_docs / np.maximum(np.maximum(1, df[order]), RARE * n_docs)).astype(np.float32)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), self.most, np.float32)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            hit = self.words[at] == hashes
            out[hit] = self.value[at[hit]]
        return out


def word_frequencies(docs: DataFrame) -> Idf:
    """Counts the documents of every word; keeps those that are not rare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0

        def out() -> pa.RecordBatch:
            words = np.concatenate(held)
            held.clear()
            words.sort()
            begin = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
            return pa.RecordBatch.from_arrays([pa.array(words[begin].view(np.int64)), pa.array(np.diff(np.append(begin, len(words))))], ["word", "n"])

        for batch in pieces(batches):
            words = words_of(batch.column(0))
            hashes, doc = words.hashes(), words.doc()
            order = np.lexsort((hashes, doc))
            hashes, doc = hashes[order], doc[order]
            new = np.ones(len(doc), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
            held.append(hashes[new])
            n += int(new.sum())
            if n >= _FLUSH:
                yield out()
                n = 0
        if n:
            yield out()

    counts = map_arrow(docs.select("text"), run, "word long, n long").groupBy("word").agg(F.sum("n").alias("df"))
    n_docs = docs.count()
    common = counts.where(F.col("df") >= max(2.0, RARE * n_docs)).toPandas()
    return Idf(common["word"].to_numpy(np.int64).view(np.uint64), common["df"].to_numpy(np.int64), n_docs)


def shingles(words: Words, idf: Idf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, hash, weight)`` of the distinct shingles, in order of text and hash."""
    w = words.hashes()
    rare = idf(w)
    keep = valid(words.first, SHINGLE)
    hashes = rolling(w, SHINGLE)[keep]
    total = np.concatenate([[0.0], np.cumsum(rare, dtype=np.float64)])
    weight = ((total[SHINGLE:] - total[:-SHINGLE]) / SHINGLE)[: len(keep)][keep] if len(w) >= SHINGLE else np.zeros(0)
    doc = words.doc()[: len(keep)][keep]
    few = np.flatnonzero((words.n > 0) & (words.n < SHINGLE))
    if len(few):
        short = np.array([int(rolling(w[words.first[k] : words.first[k + 1]], int(words.n[k]))[0]) for k in few], np.uint64)
        mean = np.array([(total[words.first[k + 1]] - total[words.first[k]]) / words.n[k] for k in few])
        hashes, weight, doc = np.concatenate([hashes, short]), np.concatenate([weight, mean]), np.concatenate([doc, few])
    order = np.lexsort((hashes, doc))
    doc, hashes, weight = doc[order], hashes[order], weight[order]
    if not len(doc):
        return doc, hashes, weight
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    return doc[begin], hashes[begin], weight[begin] * np.diff(np.append(begin, len(doc)))


def samples(doc: np.ndarray, hashes: np.ndarray, weight: np.ndarray, n_docs: int) -> np.ndarray:
    """ICWS: ``BANDS * ROWS`` samples of 32 bits for each text; zeros for one without shingles."""
    out = np.zeros((n_docs, BANDS * ROWS), np.uint32)
    if not len(doc):
        return out
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] != doc[:-1]
    begin = np.flatnonzero(new)
    segment = np.cumsum(new) - 1
    log_weight = np.log(weight).astype(np.float32)
    for k, seed in enumerate(_SEEDS):
        h = (hashes ^ seed) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        low = (h >> np.uint64(20)).astype(np.uint32)
        i = low & 4095
        beta = (h >> np.uint64(48)).astype(np.float32) * np.float32(1 / 65536)
        t = np.floor(log_weight * _INVERSE[i] + beta)
        value = _LOG[(low >> 12) & 4095] - _GAMMA[i] * (t - beta + np.float32(1))
        least = np.minimum.reduceat(value, begin)
        won = np.flatnonzero(value == least[segment])
        name = mix((hashes[won] + t[won].astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ seed).astype(np.uint32)
        np.maximum.at(out[:, k], doc[won], name)
    return out


def signatures(docs: DataFrame, idf: Idf) -> DataFrame:
    """``doc_id, key`` (of the text) and ``samples`` of each row of ``docs`` (doc_id, text, key)."""
    sent = docs.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, most_bytes=1 << 18):
            words = words_of(batch.column(0))
            got = samples(*shingles(words, sent.value), batch.num_rows)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, got.size + 1, got.shape[1], dtype=np.int32)), pa.array(got.ravel().view(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), flat], ["doc_id", "key", "samples"])

    return map_arrow(docs.select("text", "doc_id", "key"), run, "doc_id long, key string, samples array<int>")


def similarity(texts_a: pa.Array, texts_b: pa.Array, idf: Idf) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts; 0 where neither has a word."""
    (da, ha, wa), (db, hb, wb) = (shingles(words_of(t), idf) for t in (texts_a, texts_b))
    pair, h, w = np.concatenate([da, db]), np.concatenate([ha, hb]), np.concatenate([wa, wb])
    order = np.lexsort((h, pair))
    pair, h, w = pair[order], h[order], w[order]
    n = len(texts_a)
    both = np.flatnonzero((pair[1:] == pair[:-1]) & (h[1:] == h[:-1]))
    common = np.bincount(pair[both], np.minimum(w[both], w[both + 1]), n)
    every = np.bincount(pair, w, n)
    return common / np.maximum(every - common, 1e-12)


def _verified(pairs: DataFrame, texts: DataFrame, idf: Idf) -> DataFrame:
    """``a, b, similarity`` of ``pairs`` (a, b), from ``texts`` (rep, text)."""
    sent = pairs.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(pieces(batches, "text_a", 1 << 19), "text_b", 1 << 19):
            got = similarity(batch.column(2), batch.column(3), sent.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.float64())], ["a", "b", "similarity"])

    rows = pairs.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b").join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")
    return map_arrow(rows.select("a", "b", "text_a", "text_b"), run, "a long, b long, similarity double")


def _consensus(current: DataFrame, texts: DataFrame) -> DataFrame:
    """``bucket, star``: of each bucket of ``MANY`` members or more the one that has most of the bucket's
    commonest samples: the text that the others are variants of."""
    many = current.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") >= MANY).select("bucket")
    signed = current.join(many, "bucket").join(texts.select("rep", "samples"), "rep").select("bucket", "rep", F.posexplode("samples").alias("at", "sample"))
    often = signed.groupBy("bucket", "at", "sample").agg(F.count("*").alias("n")).groupBy("bucket", "at").agg(F.max_by("sample", F.struct("n", "sample")).alias("sample"))
    agreed = signed.join(often, ["bucket", "at", "sample"]).groupBy("bucket", "rep").agg(F.count("*").alias("n"))
    return agreed.groupBy("bucket").agg(F.max_by("rep", F.struct("n", "rep")).alias("center"))


def _opened(members: DataFrame, classes: DataFrame, texts: DataFrame, turn: int) -> DataFrame:
    """Members of the buckets that hold several classes, with this turn's star and both labels."""
    current = written(members.select("bucket", "rep").join(classes, "rep").select("bucket", "rep", "label"), "current")
    one = F.struct(F.col("rep").alias("star"), F.col("label").alias("star_label"))
    rank = -F.col("rep").cast("decimal(20,0)") if turn == 2 else F.xxhash64("rep", "bucket", F.lit(turn))
    stars = current.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.min_by(one, rank).alias("s")).where("x <> y").select("bucket", "s.*")
    if turn == 2:
        center = _consensus(current, texts).join(classes.select(F.col("rep").alias("center"), F.col("label").alias("center_label")), "center")
        stars = stars.join(center, "bucket", "left").select("bucket", F.coalesce("center", "star").alias("star"), F.coalesce("center_label", "star_label").alias("star_label"))
    return written(current.join(stars, "bucket"), "opened")


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) >> np.uint64(48)).astype(np.int64)


def _often(texts: DataFrame, idf: Idf) -> np.ndarray:
    """Texts that hold a shingle of each slot. Any order of shingles makes the prefix filter exact; rarest first makes it sharp."""
    sent = texts.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(SLOTS, np.int64)
        for batch in pieces(batches):
            n += np.bincount(_slot(shingles(words_of(batch.column(0)), sent.value)[1]), minlength=SLOTS)
        slots = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(n[slots])], ["slot", "n"])

    counts = map_arrow(texts.select("text"), run, "slot int, n long").groupBy("slot").agg(F.least(F.sum("n"), F.lit(2**31 - 1)).cast("int").alias("n")).toPandas()
    out = np.zeros(SLOTS, np.int32)
    out[counts["slot"].to_numpy()] = counts["n"].to_numpy()
    return out


def _prefixes(texts: DataFrame, idf: Idf, least: float) -> DataFrame:
    """``shingle, rep, label, total, rest``: the rarest shingles of each text, until the ``rest`` from one on is
    less than ``least`` of its ``total`` weight; without those that no other text has."""
    context = texts.sparkSession.sparkContext
    sent, often = context.broadcast(idf), context.broadcast(_often(texts, idf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, most_bytes=1 << 19):
            doc, hashes, weight = shingles(words_of(batch.column(0)), sent.value)
            n = often.value[_slot(hashes)]
            order = np.lexsort((hashes, n, doc))
            doc, hashes, weight, n = doc[order], hashes[order], weight[order], n[order]
            total = np.bincount(doc, weight, batch.num_rows)
            before = np.cumsum(weight) - weight
            rest = total[doc] - (before - before[np.searchsorted(doc, doc)])
            keep = np.flatnonzero((rest >= least * total[doc] * (1 - 1e-6)) & (n > 1))
            at = pa.array(doc[keep])
            columns = [pa.array(hashes[keep].view(np.int64)), batch.column(1).take(at), batch.column(2).take(at), pa.array(total[doc[keep]]), pa.array(rest[keep])]
            yield pa.RecordBatch.from_arrays(columns, ["shingle", "rep", "label", "total", "rest"])

    return map_arrow(texts.select("text", "rep", "label"), run, "shingle long, rep long, label long, total double, rest double")


def _candidates(texts: DataFrame, idf: Idf, least: float) -> DataFrame:
    """``a, b``: every pair of ``texts`` (rep, label, text) of different labels that can be similar by ``least``."""
    rows = written(_prefixes(texts, idf, least), "prefixes")
    # the shingles of a phrase are shared by the same texts: one of them stands for all. Should two lists of texts
    # have one sum of hashes, they are joined as one list, which only adds pairs
    lists = rows.groupBy("shingle").agg(F.count("*").alias("k"), F.sum(F.expr("xxhash64(rep) div 1048576")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y"), F.min("label").alias("low"), F.max("label").alias("high"))
    lists = lists.where("low <> high").select("shingle", F.xxhash64("k", "x", "y").alias("list"))
    shared = rows.join(lists, "shingle").groupBy("list", "rep", "label", "total").agg(F.max("rest").alias("rest"))
    shared = written(shared, "phrases")
    # a list's largest class is joined with the others only, never with itself
    tops = shared.groupBy("list", "label").agg(F.count("*").alias("n")).groupBy("list").agg(F.max_by("label", F.struct("n", "label")).alias("top"))
    shared = written(shared.join(tops, "list").withColumn("top", F.expr("label = top")), "shared")
    # of two texts the lighter one needs a shorter prefix: they have 2 * least / (1 + least) of it in common
    light = shared.where(F.col("rest") >= F.col("total") * (2 * least / (1 + least) * (1 - 1e-6)))
    x = light.select("list", *(F.col(c).alias(f"{c}_a") for c in ("rep", "label", "total", "rest", "top")))
    y = shared.select("list", *(F.col(c).alias(f"{c}_b") for c in ("rep", "label", "total", "rest", "top")))
    both = x.where("top_a").join(y.where("not top_b"), "list").unionByName(x.where("not top_a").join(y, "list"))
    fits = F.least("rest_a", "rest_b") >= (F.col("total_a") + F.col("total_b")) * (least / (1 + least) * (1 - 1e-6))
    return both.where(F.expr("label_a <> label_b and total_a <= total_b") & fits).select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()


def _linked(classes: DataFrame, found: DataFrame) -> DataFrame:
    """``classes`` after the links ``found``: links between documents are links between the classes that they are in by now."""
    links = found.join(classes.select(F.col("rep").alias("a"), F.col("label").alias("x")), "a").join(classes.select(F.col("rep").alias("b"), F.col("label").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    named = components(links).select(F.col("v").alias("label"), F.col("label").alias("new"))
    return written(classes.join(named, "label", "left").select("rep", F.coalesce("new", "label").alias("label")), "classes")


def _compared(pairs: DataFrame, texts: DataFrame, idf: Idf, least: float) -> tuple[DataFrame, int]:
    """The links (a, b, similarity) among ``pairs``, and how many there are."""
    found = written(_verified(pairs, texts, idf).where(F.col("similarity") >= least), "found")
    return found, found.count()


def near_duplicates(docs: DataFrame, similarity_at_least: float = SIMILARITY) -> DataFrame:
    """``doc_id, key, class_id, class_size, label`` of each row of ``docs`` (doc_id, text); ``key`` tells texts apart and
    ``label`` classes: unrelated ones have one ``class_id`` where ids are null or repeat. ``class_size`` counts documents."""
    return classes_and_links(docs, similarity_at_least)[0]


def classes_and_links(docs: DataFrame, similarity_at_least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """:func:`near_duplicates`, and the links that join its classes: ``a, b`` (keys of two texts) and their ``similarity``.

    What the results read stays in the shared folder, the other tables of the way there are deleted."""
    with recorded() as made:
        out = _classes_and_links(docs, similarity_at_least)
    dropped(docs.sparkSession, [path for path in made if path.rsplit("/", 1)[-1].rsplit("-", 1)[0] not in ("signatures", "labelled", "found", "wanted")])
    return out


#: How the key of a null text begins; all other keys are hexadecimal digests.
NO_TEXT = "null "


def _classes_and_links(docs: DataFrame, similarity_at_least: float) -> tuple[DataFrame, DataFrame]:
    docs = with_text(docs).withColumn("key", F.coalesce(F.md5(F.col("text").cast("binary")), F.concat(F.lit(NO_TEXT), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    idf = word_frequencies(docs)
    signed = written(signatures(docs, idf), "signatures")
    # copies of a text become one row, named by a number of its own: ids may repeat
    texts = signed.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("samples").alias("samples"))
    texts = written(texts.withColumn("rep", F.xxhash64("key")), "texts")
    picks = F.array(*(F.xxhash64(F.lit(b), *(F.element_at("samples", b * ROWS + r + 1) for r in range(ROWS))) for b in range(BANDS)))
    rows = texts.where(F.exists("samples", lambda x: x != 0)).select("rep", F.explode(picks).alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rep").alias("star")).where("n > 1").select("bucket", "star")
    members = written(rows.join(shared, "bucket"), "members")
    wanted = written(texts.join(members, "rep", "left_semi").select("rep", "key", "doc_id", "copies"), "wanted")
    n_wanted = wanted.count()
    mine = wanted.select("rep", "key", F.col("doc_id").alias("of"))
    held = docs.join(F.broadcast(mine) if n_wanted <= BROADCAST_ROWS else mine, "key").where(F.col("doc_id").eqNullSafe(F.col("of")))
    held = written(held.select("rep", "text"), "held")
    if held.count() > n_wanted:  # rows equal in id and text
        held = written(held.dropDuplicates(["rep"]), "held")
    classes = wanted.select("rep", F.col("rep").alias("label"))
    pairs = members.where("rep <> star").select(F.col("star").alias("a"), F.col("rep").alias("b")).distinct()
    compared, links, n_links = None, [], 0
    for turn in itertools.count(1):
        if turn > 1:
            members = _opened(members, classes, texts, turn)
            pairs = members.where("label <> star_label").select(F.least("rep", "star").alias("a"), F.greatest("rep", "star").alias("b")).distinct().join(compared, ["a", "b"], "left_anti")
            pairs = written(pairs, "pairs")
            # a turn that finds little is the last, as the exact join finds the rest; it changes no result
            if turn > 2 and n_links < PAYS * n_pairs or pairs.isEmpty():
                break
        else:
            pairs = written(pairs, "pairs")
        n_pairs = pairs.count()
        found, n_links = _compared(pairs, held, idf, similarity_at_least)
        links.append(found)
        compared = pairs if compared is None else compared.unionByName(pairs)
        if n_links:
            classes = _linked(classes, found)
    # members are those of the buckets that still hold several classes
    still = written(members.select("rep", "label").distinct(), "still")
    if not still.isEmpty():
        still = written(held.join(counted(still), "rep").select("rep", "label", "text"), "open")
        pairs = written(_candidates(still, idf, similarity_at_least).join(compared, ["a", "b"], "left_anti"), "pairs")
        found, n_links = _compared(pairs, held, idf, similarity_at_least)
        links.append(found)
        if n_links:
            classes = _linked(classes, found)
    # names of the classes: a text that met no other in a bucket is its own
    sizes = classes.join(wanted, "rep").groupBy("label").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    named = written(classes.join(counted(written(sizes, "sizes")), "label").select("rep", "label", "class_id", "class_size"), "named")
    labelled = texts.select("key", "rep", "doc_id", "copies").join(named, "rep", "left")
    labelled = labelled.select("key", F.coalesce("label", "rep").alias("label"), F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", "copies").alias("class_size"))
    every = links[0]
    for found in links[1:]:
        every = every.unionByName(found)
    keys = wanted.select("rep", "key")
    every = every.join(keys.select(F.col("rep").alias("a"), F.col("key").alias("key_a")), "a").join(keys.select(F.col("rep").alias("b"), F.col("key").alias("key_b")), "b")
    out = signed.select("doc_id", "key").join(written(labelled, "labelled"), "key")
    # a null text is no copy, not even of another one under the same id
    size = F.when(F.startswith("key", F.lit(NO_TEXT)), F.lit(1).cast("long")).otherwise(F.col("class_size")).alias("class_size")
    out = out.select("doc_id", "key", "class_id", size, "label")
    return out, every.select(F.col("key_a").alias("a"), F.col("key_b").alias("b"), "similarity")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id", "class_size")
