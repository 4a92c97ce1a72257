"""Text quality by attention-based multiple-instance learning.

A document is a bag of passages of 48 words. Every passage is encoded (shares of kinds of characters,
shapes of words, repetition), a gated attention net learns from the labels of whole documents how
much each passage counts, and the attention-weighted sum of the passages' codes is scored. So a
passage of junk can decide about a long document, and the attention says which one it was.

The net is fitted in numpy on at most ``MOST`` labelled rows per label; all documents are scored, whole.

Defined results: a null or empty text is scored as one empty passage; repeated rows each give their
row; a null doc_id is not held out; without rows of both labels every score is the share of label 1
(0.5 without any); a very long text is scored whole; other columns, such as lang and source, are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmark.llm.common import column_or_null, map_arrow, pieces
from foldmark.llm.labelled import Adam, Blocks, remainder, sample, sigmoid
from foldmark.llm.words import words_of

MOST, PASSAGE, CODE, GATE = 4000, 48, 24, 12
THRESHOLD = 0.7

_KINDS = 18
_CLASS = np.full(256, _KINDS - 1, np.uint8)  # else: other ASCII marks
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[128:] = 3
_CLASS[[32, 9, 11, 12]] = 4
for _k, _c in enumerate("\n\r.,!?|*$%&#-\"", 5):
    _CLASS[ord(_c)] = min(_k, _KINDS - 2)
N_FEATURES = _KINDS + 9


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each passage, and each text's first row (one more entry at the end)."""
    words = words_of(texts)
    n = words.n
    per_doc = np.maximum(1, -(-n // PASSAGE))
    bags = np.concatenate([[0], np.cumsum(per_doc)])
    total = int(bags[-1])
    out = np.zeros((total, N_FEATURES), np.float32)
    if not len(words.starts):
        out[:, _KINDS + 7] = 1.0  # as below: without words none is said twice
        return out, bags
    doc = words.doc()
    own = bags[doc] + (np.arange(len(doc)) - words.first[doc]) // PASSAGE
    # bytes up to the next word belong to a word's passage
    owner = np.repeat(own, np.diff(np.append(words.starts, len(words.data))))
    body = words.data[words.starts[0] :]
    # white space behind a text's last word may be the next text's: it belongs to no passage
    last = words.first[1:][n > 0] - 1
    edge = np.zeros(len(body) + 1, np.int64)
    edge[words.ends[last] - words.starts[0]] += 1
    edge[np.append(words.starts, len(words.data))[last + 1] - words.starts[0]] -= 1
    owner[np.cumsum(edge)[:-1] > 0] = total
    kinds = np.bincount(owner * _KINDS + _CLASS[body], minlength=(total + 1) * _KINDS).reshape(-1, _KINDS)[:total]
    size = np.maximum(1, kinds.sum(1, keepdims=True))
    out[:, :_KINDS] = np.sqrt(kinds / size)
    count = np.bincount(own, minlength=total)
    some = np.maximum(1, count)
    length = words.ends - words.starts
    first, last = words.data[words.starts], words.data[words.ends - 1]  # bytes of each word
    hashes = words.hashes()
    same = np.zeros(len(doc), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (own[1:] == own[:-1])
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(own[order], kind="stable")]
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (own[order][1:] != own[order][:-1])
    distinct = np.bincount(own[order][new], minlength=total)
    of = lambda mask: np.bincount(own, mask, total) / some
    extra = (
        np.log1p(of(length)), of(length == 1), of(length > 20), of((first >= 65) & (first <= 90)), of((last == 46) | (last == 44)),
        of(_CLASS[last] >= 9), of(same), np.where(count > 0, distinct / some, 1.0), np.minimum(count, PASSAGE) / PASSAGE,
    )
    for k, value in enumerate(extra):
        out[:, _KINDS + k] = value
    return out, bags


@dataclass
class Net:
    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]
    constant: float | None = None

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        w, starts = self.w, bags[:-1]
        x = (x - self.mean) / self.scale
        code = np.tanh(x @ w["a"] + w["a0"])
        left, right = np.tanh(code @ w["v"] + w["v0"]), sigmoid(code @ w["u"] + w["u0"])
        weight = (left * right) @ w["g"]
        bag = np.repeat(np.arange(len(starts)), np.diff(bags))
        weight = np.exp(weight - np.maximum.reduceat(weight, starts)[bag])
        weight /= np.add.reduceat(weight, starts)[bag]
        pooled = np.add.reduceat(code * weight[:, None], starts)
        return {"x": x, "code": code, "left": left, "right": right, "weight": weight, "pooled": pooled, "bag": bag, "score": sigmoid(pooled @ w["c"] + w["c0"])}

    def score(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bags) - 1, self.constant)
        return self.forward(x, bags)["score"]


def fit(blocks: Blocks, epochs: int = 30, batch: int = 64, rate: float = 0.005, seed: int = 11) -> Net:
    rng = np.random.default_rng(seed)
    y = np.array([label for label, _ in blocks], float)
    none = Net(np.zeros(N_FEATURES), np.ones(N_FEATURES), {})
    if len(set(y)) < 2:
        none.constant = float(y.mean()) if len(y) else 0.5
        return none
    bags = [np.frombuffer(b, np.float16).reshape(-1, N_FEATURES).astype(np.float64) for _, b in blocks]
    every = np.concatenate(bags)
    init = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    w = {"a": init(N_FEATURES, CODE), "a0": np.zeros(CODE), "v": init(CODE, GATE), "v0": np.zeros(GATE), "u": init(CODE, GATE), "u0": np.zeros(GATE), "g": init(GATE), "c": init(CODE), "c0": np.zeros(1)}
    net = Net(every.mean(0), every.std(0) + 1e-3, w)
    adam = Adam(w, rate)
    share = y.mean()
    cost = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) ** 0.5
    for epoch in range(epochs):
        adam.rate = rate * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            own = order[at : at + batch]
            edges = np.concatenate([[0], np.cumsum([len(bags[k]) for k in own])])
            s = net.forward(np.concatenate([bags[k] for k in own]), edges)
            delta = cost[own] * (s["score"] - y[own]) / len(own)
            d_pool = delta[:, None] * w["c"]
            up = d_pool[s["bag"]]
            d_weight = (up * s["code"]).sum(1)
            inner = np.add.reduceat(d_weight * s["weight"], edges[:-1])[s["bag"]]
            d_att = s["weight"] * (d_weight - inner)
            d_gate = d_att[:, None] * w["g"]
            d_left = d_gate * s["right"] * (1 - s["left"] ** 2)
            d_right = d_gate * s["left"] * s["right"] * (1 - s["right"])
            d_code = (up * s["weight"][:, None] + d_left @ w["v"].T + d_right @ w["u"].T) * (1 - s["code"] ** 2)
            adam.step({
                "a": s["x"].T @ d_code + 1e-4 * w["a"], "a0": d_code.sum(0), "v": s["code"].T @ d_left, "v0": d_left.sum(0), "u": s["code"].T @ d_right, "u0": d_right.sum(0),
                "g": (s["left"] * s["right"]).T @ d_att, "c": s["pooled"].T @ delta + 1e-4 * w["c"], "c0": delta.sum(keepdims=True),
            })
    return net


def _encode(texts: pa.Array) -> list[bytes]:
    x, bags = passages(texts)
    return [x[a:b].astype(np.float16).tobytes() for a, b in zip(bags[:-1], bags[1:], strict=True)]


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = MOST) -> Net:
    """The net from at most ``most`` rows of each label whose id may be learned from."""
    return fit(sample(docs, labels, "quality", remainder(4) != 2, {0: most, 1: most}, _encode))


def score_quality(docs: DataFrame, net: Net, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """The columns ``keep`` of each document and its score as ``name``."""
    sent = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(*dict.fromkeys((*keep, "text")))
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            score = sent.value.score(*passages(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(score, pa.float64())], [*keep, name])

    return map_arrow(rows, run, schema)


def with_text(docs: DataFrame) -> DataFrame:
    return docs.select(column_or_null(docs, "doc_id", T.LongType()).alias("doc_id"), column_or_null(docs, "text", T.StringType()).alias("text"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_text(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    net = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, net).select(
        "doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
