"""Bounded samples of labelled rows, as features, for fitting on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmark.llm.common import column_or_null, map_arrow

Blocks = list[tuple[int, bytes]]
MOST_BYTES = 1 << 20  # of an encoded text; a longer one is scored but not learned from


def remainder(n: int) -> Column:
    """crc32 of the document id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, most: dict[int, int], encode: Callable[[pa.Array], list[bytes]]) -> Blocks:
    """``(label, encoded text)`` of up to ``most[label]`` labelled rows each, in order of a hash of the id.

    ``usable`` says which ids may be learned from. The sample is bounded whatever the input, so its
    ids are broadcast to the documents; the texts are encoded where they lie. Should an id have several texts,
    the sample still holds no more rows than were asked for, and no text of more than ``MOST_BYTES``.
    """
    labels = labels.select(column_or_null(labels, "doc_id", T.LongType()).alias("doc_id"), column_or_null(labels, label, T.IntegerType()).alias("label"))
    parts = [labels.where((F.col("label") == value) & usable).dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for value, n in most.items()]
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoded = pa.array(encode(batch.column(2)), pa.binary())
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), encoded], ["doc_id", "label", "encoded"])
            yield out.filter(pc.less_equal(pc.binary_length(encoded), MOST_BYTES))

    found = map_arrow(rows, run, "doc_id long, label int, encoded binary")
    found = found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("encoded")).limit(sum(most.values())).toPandas()
    found = found.sort_values(["doc_id", "label"], kind="stable")
    return list(zip(found["label"].astype(int), found["encoded"].map(bytes), strict=True))


class Adam:
    """Adaptive steps for a dictionary of arrays."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.t = weights, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.weights[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
