"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of three rows of one table: of the hash of the folded word and of its
first 4 and 6 bytes, so that unseen words share what their beginnings have taught. Filters of widths
1 to 3 run over the words of the whole text, each is max-pooled (those of width 1 to their four greatest
distinct values, as one bad word may be chance), and a logistic layer scores the pooled values. Everything is trained in numpy on at most ``MOST`` labelled rows of each label;
one embedding coordinate starts from the log odds of its slot, the rest at random.

Thresholds are calibrated by language on cross-fitted scores: every labelled row that may be learned from is
scored by a net that has not seen it. The language is guessed from the text alone (function words); a score is
shifted by its language's threshold so that 0.5 is the point of decision everywhere.

Defined results: a null or empty text pools only padding and gets that score; repeated rows each
give their row; a null doc_id is not held out; without rows of both labels every score is the share
of label 1 (0 without any); a very long text is scored whole; lang, source and other columns are never read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.llm.common import map_arrow, pieces
from foldmark.llm.labelled import Adam, Blocks, remainder, sample, sigmoid
from foldmark.llm.quality import with_text
from foldmark.llm.words import words_of

MOST, SLOTS, DIM, FILTERS, WIDTHS = 3000, 1 << 16, 12, 12, (1, 2, 3)
POOLS = ((1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (3, 0))  # filter width, and rank among the distinct values over the text
THRESHOLD, FOLDS, FEW, RECALL = 0.5, 3, 10, 1.5
_PAD = max(WIDTHS) - 1
_PREFIXES = (4, 6)
# fixed values: frequent function words
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on are with as be at this by from not",
    "de": "der die und das den von zu mit sich des auf für ist im dem nicht ein eine auch es",
    "fr": "le la les de des et un une du en que qui dans pour pas sur au avec ce est",
    "es": "el la los de las y un una del en que por con para no se su al lo es",
}
LANGUAGES = ("other", *FUNCTION_WORDS)


def _language_table() -> tuple[np.ndarray, np.ndarray]:
    keys, votes = [], []
    for k, line in enumerate(FUNCTION_WORDS.values(), 1):
        keys.append(words_of(pa.array([line])).hashes())
        votes += [k] * len(keys[-1])
    h, v = np.concatenate(keys), np.array(votes)
    hashes = np.unique(h)
    table = np.zeros((len(hashes), len(LANGUAGES)), np.float32)
    np.add.at(table, (np.searchsorted(hashes, h), v), 1.0)
    return hashes, table / table.sum(1, keepdims=True)


_HASHES, _VOTES = _language_table()


def slots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the embedding table for each word, each text's first word, each text's language."""
    words = words_of(texts).trimmed()
    whole = words.hashes(lower=True)
    places = [whole % SLOTS]
    for k, size in enumerate(_PREFIXES, 1):
        places.append((words.hashes(prefix=size, lower=True) + np.uint64(k * 0x9E3779B9)) % SLOTS)
    out = np.stack(places, 1).astype(np.uint16)
    votes = np.zeros((len(words.first) - 1, len(LANGUAGES)))
    votes[:, 0] = 0.01
    at = np.minimum(np.searchsorted(_HASHES, whole), len(_HASHES) - 1)
    hit = np.flatnonzero(_HASHES[at] == whole)
    doc = words.doc()[hit]
    for k in range(1, len(LANGUAGES)):
        votes[:, k] = np.bincount(doc, _VOTES[at[hit], k], len(votes))
    return out, words.first, votes.argmax(1)


@dataclass
class Net:
    w: dict[str, np.ndarray]
    shift: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))
    constant: float | None = None

    def forward(self, places: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        n = np.diff(first)
        starts = first[:-1] + _PAD * np.arange(len(n))  # padding after each text, so no window crosses two
        rows = np.arange(int(first[-1])) + np.repeat(_PAD * np.arange(len(n)), n)
        x = np.zeros((int(first[-1]) + _PAD * len(n) + _PAD, DIM), np.float32)
        table = self.w["table"]
        x[rows] = table[places[:, 0]] + table[places[:, 1]] + table[places[:, 2]]
        total = len(x) - _PAD
        spans = np.diff(np.append(starts, total))
        padding = np.ones(total, bool)  # a window that starts there sees nothing of the next text
        padding[rows] = False
        pooled, arg = [], []
        for k in WIDTHS:
            z = np.zeros((total, FILTERS), np.float32)
            for j in range(k):
                z += x[j : j + total] @ self.w[f"f{k}"][j]
            z[padding] = 0
            for rank in (r for width, r in POOLS if width == k):
                if rank:  # without the value before, but for rounding: equal words count once
                    z = np.where(z > np.repeat(top, spans, 0) - np.float32(1e-3), -np.inf, z)
                top = np.maximum.reduceat(z, starts)
                pooled.append(np.maximum(top + self.w[f"b{k}.{rank}"], 0))
                arg.append(z)
        h = np.concatenate(pooled, 1)
        return {"x": x, "rows": rows, "starts": starts, "h": h, "z": arg, "padding": padding, "logit": h @ self.w["o"] + self.w["o0"]}

    def score(self, places: np.ndarray, first: np.ndarray, language: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        return sigmoid(self.forward(places, first)["logit"].astype(np.float64) - self.shift[language])


def _stack(blocks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(blocks), np.concatenate([[0], np.cumsum([len(b) for b in blocks])])


def fit(blocks: Blocks, epochs: int = 4, folds: int = FOLDS, seed: int = 13, spark: SparkSession | None = None) -> Net:
    """The net of all ``blocks``, with thresholds by language that are cross-fitted.

    Each fold is scored by a net that has not seen it; of these logits every language with ``FEW`` rows of
    either label gets the threshold where precision and recall are best together, the others the general one.
    The nets are independent: with ``spark`` each is trained by a task of its own.
    """
    y = np.array([label for label, _ in blocks], np.float32)
    net = Net({})
    if len(set(y)) < 2:
        net.constant = float(y.mean()) if len(y) else 0.0
        return net
    language = np.array([b[0] for _, b in blocks])
    # rows of a label and language in turn, so that each fold has its share of every one
    turn = np.zeros(len(y), np.int64)
    for value in (0, 1):
        for lang in range(len(LANGUAGES)):
            own = np.flatnonzero((y == value) & (language == lang))
            turn[own] = np.arange(len(own)) % folds

    def train(k: int, blocks: Blocks) -> tuple[Net | None, np.ndarray]:
        """The net without fold ``k`` and its logits of that fold; for ``folds`` the net of all rows."""
        docs = [np.frombuffer(b, np.uint16, offset=2).reshape(-1, 1 + len(_PREFIXES)).astype(np.int64) for _, b in blocks]
        if k == folds:
            return _trained(docs, y, np.arange(len(y)), epochs, seed), np.zeros(0)
        own = turn == k
        if not own.any() or len(set(y[~own])) < 2:
            return None, np.zeros(int(own.sum()))
        part = _trained(docs, y, np.flatnonzero(~own), epochs, seed + k + 1)
        return None, np.concatenate([part.forward(*_stack([docs[j]]))["logit"] for j in np.flatnonzero(own)])

    if spark is None:
        made = [train(k, blocks) for k in range(folds + 1)]
    else:
        sent = spark.sparkContext.broadcast(blocks)  # the bounded sample

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([pickle.dumps(train(k, sent.value))], pa.binary())], ["k", "made"])

        rows = map_arrow(spark.range(0, folds + 1, 1, folds + 1).toDF("k"), run, "k long, made binary").collect()
        made = [pickle.loads(r.made) for r in sorted(rows, key=lambda r: r.k)]
    out = np.zeros(len(y))
    for k in range(folds):
        out[turn == k] = made[k][1]
    net = made[folds][0]
    general = _threshold(out, y, 0.0)
    for lang in range(len(LANGUAGES)):
        own = language == lang
        net.shift[lang] = _threshold(out[own], y[own], general) if min((y[own] == 1).sum(), (y[own] == 0).sum()) >= FEW else general
    return net


def _trained(docs: list[np.ndarray], y: np.ndarray, train: np.ndarray, epochs: int, seed: int, batch: int = 32, rate: float = 0.01) -> Net:
    """A net after gradient steps over the rows ``train``; both labels count alike."""
    rng = np.random.default_rng(seed)
    net = Net({})
    seen = np.zeros((2, SLOTS))
    for k in train:
        seen[int(y[k]), np.unique(docs[k])] += 1
    n0, n1 = (y[train] == 0).sum(), (y[train] == 1).sum()
    odds = np.log((seen[1] + 0.5) / (n1 + 1)) - np.log((seen[0] + 0.5) / (n0 + 1))
    odds[seen.sum(0) < 3] = 0
    table = rng.normal(0, 0.05, (SLOTS, DIM)).astype(np.float32)
    table[:, 0] = odds / 3
    w = {"table": table, "o": np.zeros(FILTERS * len(POOLS), np.float32), "o0": np.zeros(1, np.float32)}
    for k in WIDTHS:
        w[f"f{k}"] = rng.normal(0, 0.3 / np.sqrt(k * DIM), (k, DIM, FILTERS)).astype(np.float32)
        w[f"f{k}"][:, 0, 0] += 1 / k
    for k, rank in POOLS:
        w[f"b{k}.{rank}"] = np.full(FILTERS, -0.1, np.float32)
    w["o"][::FILTERS] = 1.0
    w["o0"] -= 2
    net.w = w
    dense = Adam({k: v for k, v in w.items() if k != "table"}, rate)
    pace = np.full((SLOTS, 1), 1e-3, np.float32)
    share = y[train].mean()
    cost = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    for epoch in range(epochs):
        dense.rate = rate * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(train)
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            places, first = _stack([docs[k] for k in own])
            s = net.forward(places, first)
            delta = (cost[own] * (sigmoid(s["logit"]) - y[own]) / len(own)).astype(np.float32)
            grads = {"o": s["h"].T @ delta + 1e-4 * w["o"], "o0": delta.sum(keepdims=True)}
            dx_at, dx = [], []
            ends = np.append(s["starts"][1:], len(s["z"][0]))
            grads |= {f"f{k}": np.zeros_like(w[f"f{k}"]) for k in WIDTHS}
            for g, (k, rank) in enumerate(POOLS):
                part = slice(g * FILTERS, (g + 1) * FILTERS)
                d = delta[:, None] * w["o"][part] * (s["h"][:, part] > 0)
                top = np.stack([a + s["z"][g][a:b].argmax(0) for a, b in zip(s["starts"], ends, strict=True)])
                grads[f"b{k}.{rank}"] = d.sum(0)
                d = np.where(s["padding"][top], np.float32(0), d)
                for j in range(k):
                    grads[f"f{k}"][j] += np.einsum("bfd,bf->df", s["x"][top + j], d)
                    dx_at.append((top + j).ravel())
                    dx.append((d[:, :, None] * w[f"f{k}"][j].T[None]).reshape(-1, DIM))
            dense.step(grads)
            # only the words of the windows that won are moved
            word = np.full(len(s["x"]), -1)
            word[s["rows"]] = np.arange(len(places))
            at_word, value = word[np.concatenate(dx_at)], np.concatenate(dx)
            real = at_word >= 0
            rows, value = places[at_word[real]].ravel(), np.repeat(value[real], places.shape[1], 0)
            touched, back = np.unique(rows, return_inverse=True)
            step = np.zeros((len(touched), DIM), np.float32)
            np.add.at(step, back, value)
            pace[touched, 0] += (step**2).mean(1)
            table[touched] -= 0.02 * step / np.sqrt(pace[touched])
    return net


def _threshold(logit: np.ndarray, y: np.ndarray, otherwise: float) -> float:
    """Where precision and recall, which counts ``RECALL`` times as much, are best together, in the middle of the gap there."""
    if len(set(y)) < 2:
        return otherwise
    order = np.argsort(-logit)
    hits = np.cumsum(y[order])
    both = (1 + RECALL**2) * hits / (np.arange(1, len(y) + 1) + RECALL**2 * y.sum())
    k = int(both.argmax())
    return float((logit[order][k] + logit[order][min(k + 1, len(y) - 1)]) / 2)


def _encode(texts: pa.Array) -> list[bytes]:
    places, first, language = slots(texts)
    return [bytes([lang, 0]) + places[a:b].tobytes() for a, b, lang in zip(first[:-1], first[1:], language, strict=True)]


def fit_toxicity(docs: DataFrame, labels: DataFrame, most: int = MOST) -> Net:
    """The net from at most ``most`` rows of each label whose id may be learned from."""
    return fit(sample(docs, labels, "toxic", remainder(5) != 0, {0: most, 1: most}, _encode), spark=docs.sparkSession)


def score_toxicity(docs: DataFrame, net: Net) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(net)  # 3 MB, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, most_bytes=1 << 19):
            score = sent.value.score(*slots(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, score double")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_text(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    net = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, net).select(
        "doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
