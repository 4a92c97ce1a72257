"""Vector compression: four indexes of one byte for each vector, into codebooks learned on all vectors.

1. Vectors become integers, ``floor(1024 * x)``, once; they are written as a table with their whole rows.
2. A codebook for each part of the vectors starts from the vectors of the least ids. In every round the driver
   grows a kd-tree of each codebook and broadcasts it (some hundred kilobytes, whatever the input); tasks find the
   nearest entries by branch and bound and emit, once a task, the count and the componentwise sum of each entry's
   parts. Spark adds these up; the driver gets one row for each entry and floors the means.
3. A last search gives every vector its code and its error; errors are added up by label.

Branch and bound: a query first goes down to the leaf on its own side of every cut; then all nodes whose box is
at most as far as the best so far are visited, those at equal distance too, so that of equally near entries the
one of the lower index is found whichever leaf it lies in. Sums and distances are exact: they are doubles while
all of them stay under 2**53, and Python integers beyond.

Defined results: a vector that is null or holds null or non-finite components has no row. The vectors' length is
the most frequent one (of equally frequent the longest); rows of another length keep their row with null code and
error, and add nothing to ``label_error``. A length that four does not divide is filled up with zeros, which
are not printed. Components whose integer is beyond 2**62 count as 2**62, errors beyond a long as the greatest long.
Equal ids are entries in order of their components, null ids come last; with fewer vectors than entries the
codebooks are as short. An empty table gives an empty result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmark.llm.common import column_or_null, counted, map_arrow, written

PARTS, ENTRIES, ROUNDS, SCALE, LEAF = 4, 256, 4, 1024, 16
_MOST = 1 << 62
_ROWS = 4096  # vectors that are searched at a time
_LONG = (1 << 63) - 1


@dataclass
class _Node:
    low: np.ndarray
    high: np.ndarray
    members: np.ndarray | None = None  # of a leaf, ascending
    axis: int = 0
    cut: float = 0
    children: tuple[int, int] = (0, 0)


@dataclass
class KdTree:
    """The entries of one codebook, (n, width), in boxes."""

    entries: np.ndarray
    nodes: list[_Node] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.square = (self.entries * self.entries).sum(1)
        self._grow(np.arange(len(self.entries)))

    def _grow(self, members: np.ndarray) -> int:
        own, at = self.entries[members], len(self.nodes)
        node = _Node(own.min(0), own.max(0))
        self.nodes.append(node)
        extent = node.high - node.low
        if len(members) <= LEAF or not extent.any():
            node.members = np.sort(members)
            return at
        node.axis = int(np.argmax(extent))
        order = members[np.argsort(own[:, node.axis], kind="stable")]
        half = len(order) // 2
        node.cut = self.entries[order[half], node.axis]
        node.children = (self._grow(order[:half]), self._grow(order[half:]))
        return at

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry for each row of ``x``, of equally near ones the least index."""
        square = (x * x).sum(1)
        best, entry = np.zeros(len(x), x.dtype), np.full(len(x), -1)
        home = np.zeros(len(x), int)

        def look(at: int, rows: np.ndarray) -> None:
            members = self.nodes[at].members
            d = square[rows][:, None] - 2 * (x[rows] @ self.entries[members].T) + self.square[members]
            k = np.argmin(d, axis=1)  # the first of equals
            d, found = d[np.arange(len(rows)), k], members[k]
            better = (entry[rows] < 0) | (d < best[rows]) | (d == best[rows]) & (found < entry[rows])
            best[rows[better]], entry[rows[better]] = d[better], found[better]

        down = [(0, np.arange(len(x)))]
        while down:  # to the leaf on the own side of each cut
            at, rows = down.pop()
            node = self.nodes[at]
            if not len(rows):
                continue
            if node.members is not None:
                home[rows] = at
                look(at, rows)
                continue
            left = (x[rows, node.axis] < node.cut).astype(bool)
            down += [(node.children[0], rows[left]), (node.children[1], rows[~left])]
        visit = [(0, np.arange(len(x)))]
        while visit:  # and to every box that may hold an entry as near
            at, rows = visit.pop()
            node, own = self.nodes[at], x[rows]
            gap = np.maximum(np.maximum(node.low - own, own - node.high), 0)
            rows = rows[((gap * gap).sum(1) <= best[rows]).astype(bool)]
            if not len(rows):
                continue
            if node.members is None:
                visit += [(child, rows) for child in reversed(node.children)]
            elif len(rows := rows[home[rows] != at]):
                look(at, rows)
        return entry, best


@dataclass
class Codebooks:
    """``entries[part][entry]`` as Python integers, of vectors of ``size`` components in parts of ``width``."""

    entries: list[list[list[int]]]
    size: int
    width: int
    most: int  # the greatest absolute component of the vectors

    @property
    def kind(self) -> type:
        return np.float64 if 4 * max(1, self.width) * max(1, self.most) ** 2 < 2**53 else object

    def trees(self) -> list[KdTree]:
        return [KdTree(np.array(part, self.kind).reshape(len(part), self.width)) for part in self.entries]

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and position, without what fills up the last part."""
        shown = [e[: max(0, min(self.width, self.size - k * self.width))] for k, part in enumerate(self.entries) for e in part]
        return hashlib.sha256(",".join(str(v) for e in shown for v in e).encode()).hexdigest()


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, size, most, v`` (lazy): integer components of the vectors that have nothing but finite ones."""
    label = vectors.schema["label"].dataType if "label" in vectors.columns else T.IntegerType()
    rows = vectors.select(
        column_or_null(vectors, "vec_id", T.LongType()).alias("vec_id"),
        column_or_null(vectors, "label", label).alias("label"),
        column_or_null(vectors, "embedding", T.ArrayType(T.DoubleType())).alias("embedding"),
    )
    fields = [T.StructField("size", T.IntegerType()), T.StructField("most", T.LongType()), T.StructField("v", T.ArrayType(T.LongType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            numbers = lists.values.to_numpy(zero_copy_only=False).astype(float)  # null components become not-a-numbers
            bad = np.append(0, np.cumsum(~np.isfinite(numbers)))
            good = (bad[offsets[1:]] == bad[offsets[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False)
            with np.errstate(all="ignore"):
                v = np.clip(np.nan_to_num(np.floor(numbers * scale)), -_MOST, _MOST).astype(np.int64)
            most, some = np.zeros(len(batch), np.int64), offsets[1:] > offsets[:-1]
            if some.any():
                most[some] = np.maximum.reduceat(np.abs(v), offsets[:-1][some])
            out = [batch.column(0), batch.column(1), pa.array(np.diff(offsets), pa.int32()), pa.array(most), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(v))]
            yield pa.RecordBatch.from_arrays(out, ["vec_id", "label", "size", "most", "v"]).filter(pa.array(good))

    return map_arrow(rows, run, T.StructType([*rows.schema.fields[:2], *fields]))


def _blocks(batches: Iterator[pa.RecordBatch], column: int, size: int, width: int, kind: type) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their vectors as (rows, parts, width), filled up with zeros."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            own = batch.slice(at, _ROWS)
            x = np.zeros((own.num_rows, PARTS * width), kind)
            x[:, :size] = own.column(column).flatten().to_numpy().reshape(own.num_rows, size)
            yield own, x.reshape(own.num_rows, PARTS, width)


def updated(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round: each entry becomes the floored mean of the parts that are nearest to it."""
    size, width, kind = books.size, books.width, books.kind
    sent = vectors.sparkSession.sparkContext.broadcast(books.trees())
    n_entries = len(books.entries[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((PARTS, n_entries), np.int64)
        total = np.zeros((PARTS, n_entries, width), object)
        for own, x in _blocks(batches, 0, size, width, kind):
            for part, tree in enumerate(sent.value):
                entry, _ = tree.nearest(x[:, part])
                n[part] += np.bincount(entry, minlength=n_entries)
                order = np.argsort(entry, kind="stable")
                used, first = np.unique(entry[order], return_index=True)
                total[part, used] += np.add.reduceat(x[order, part], first, axis=0).astype(np.int64 if kind is float or kind is np.float64 else object)
        part, entry = np.nonzero(n)
        sums = [[Decimal(int(v)) for v in total[p, e]] for p, e in zip(part, entry, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry]), pa.array(sums, pa.list_(pa.decimal128(38, 0)))], ["part", "entry", "n", "s"]
        )

    rows = map_arrow(vectors.where(F.col("size") == size).select("v"), run, "part int, entry int, n long, s array<decimal(38,0)>")
    found = rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("s")[k]) for k in range(width))).cast("array<decimal(38,0)>").alias("s")).collect()
    sent.unpersist()
    entries = [[list(e) for e in part] for part in books.entries]
    for r in found:
        entries[r.part][r.entry] = [int(v) // r.n for v in r.s]
    return Codebooks(entries, size, width, books.most)


def fit_codebooks(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of ``vectors`` (the written rows of :func:`whole_vectors`); none if there is no vector."""
    sizes = vectors.groupBy("size").agg(F.count("*").alias("n"), F.max("most").alias("most")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    if not sizes:
        return None
    size, width = sizes[0]["size"], -(-sizes[0]["size"] // PARTS)
    first = vectors.where(F.col("size") == size).orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).collect()
    filled = [list(r.v) + [0] * (PARTS * width - size) for r in first]
    books = Codebooks([[v[k * width : (k + 1) * width] for v in filled] for k in range(PARTS)], size, width, sizes[0]["most"])
    for _ in range(rounds):
        books = updated(vectors, books)
    return books


def coded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` of each vector (lazy)."""
    size, width, kind = books.size, books.width, books.kind
    sent = vectors.sparkSession.sparkContext.broadcast(books.trees())
    schema = T.StructType([*vectors.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, x in _blocks(batches, 2, size, width, kind):
            found = [tree.nearest(x[:, part]) for part, tree in enumerate(sent.value)]
            code = [bytes(c).hex() for c in np.stack([e for e, _ in found], axis=1).astype(np.uint8)]
            error = [min(_LONG, int(e)) for e in sum(d for _, d in found)]
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(code, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    out = map_arrow(vectors.where(F.col("size") == size).select("vec_id", "label", "v"), run, schema)
    other = vectors.where(F.col("size") != size)
    return out.unionByName(other.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")))


def vector_codes(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for each whole vector of ``vectors`` (vec_id, embedding, label)."""
    if entries > 256:
        raise ValueError("a code has one byte for each part")
    whole = written(whole_vectors(vectors), "vectors")
    books = fit_codebooks(whole, entries, rounds)
    digest = books.digest() if books else ""
    rows = written(coded(whole, books) if books else whole.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), "coded")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    sums = counted(written(rows.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")), "label-errors"))
    joined = rows.join(sums, F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select("vec_id", "code", "error", F.when(F.col("code").isNotNull(), F.col("label_error")).alias("label_error"), F.lit(digest).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql() -> str:
    """The rounds one after the other; distances by inner products of whole numbers, which doubles hold exactly."""
    steps = [
        "kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings"
        " WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "parts AS MATERIALIZED (SELECT rid, part, list_slice(v, (part * len(v) // 4 + 1)::BIGINT, ((part + 1) * len(v) // 4)::BIGINT) AS p FROM kept, range(4) AS r(part))",
        "leads AS (SELECT rid, row_number() OVER (ORDER BY vec_id, v) - 1 AS entry FROM kept)",
        "book0 AS MATERIALIZED (SELECT part, entry, p AS e FROM leads JOIN parts USING (rid) WHERE entry < 256)",
    ]
    near = "SELECT rid, part, min({{'d': list_inner_product(p, p) - 2 * list_inner_product(p, e) + list_inner_product(e, e), 'entry': entry}}) AS best FROM parts JOIN book{} USING (part) GROUP BY ALL"
    for k in range(ROUNDS):
        steps += [
            f"near{k} AS MATERIALIZED ({near.format(k)})",
            f"mean{k} AS (SELECT part, best.entry AS entry, pos, floor(sum(p[pos + 1]) / count(*)) AS m FROM near{k} JOIN parts USING (rid, part), range((SELECT max(len(p)) FROM parts)) AS r(pos) GROUP BY ALL)",
            f"fresh{k} AS (SELECT part, entry, list(m ORDER BY pos) AS e FROM mean{k} GROUP BY ALL)",
            f"book{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(f.e, b.e) AS e FROM book{k} AS b LEFT JOIN fresh{k} AS f USING (part, entry))",
        ]
    steps += [
        f"last AS ({near.format(ROUNDS)})",
        "code AS (SELECT rid, string_agg(format('{:02x}', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM last GROUP BY rid)",
        f"digest AS (SELECT sha256(string_agg(list_aggregate(list_transform(e, lambda x: x::BIGINT), 'string_agg', ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{ROUNDS})",
    ]
    return (
        "WITH " + ", ".join(steps) + " SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN code USING (rid), digest"
    )


OP12_SQL = _sql()
