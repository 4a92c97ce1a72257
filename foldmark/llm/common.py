"""Session helpers shared by the operators: shared folder, written stages, Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a plain local session (tests) may go without; it then gets a temporary folder.
    """
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"file://{tempfile.gettempdir()}/foldmark-shared"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/foldmark/{name}-{uuid.uuid4().hex[:12]}"


#: Open blocks of this thread; what other threads write is theirs.
_recording: ContextVar[tuple[list[str], ...]] = ContextVar("recording", default=())


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of the tables that :func:`written` makes inside, for :func:`dropped`."""
    made: list[str] = []
    token = _recording.set((*_recording.get(), made))
    try:
        yield made
    finally:
        _recording.reset(token)


def dropped(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it again.

    Unlike ``checkpoint()`` this computes the rows once, keeps them columnar and compressed, and a
    lost executor costs nothing that was already written.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    for made in _recording.get():
        made.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of ids or labels that may be broadcast; tables are counted before, and joined by shuffle beyond.
BROADCAST_ROWS = 500_000


def counted(df: DataFrame) -> DataFrame:
    """``df`` (written, a few numbers a row) as a broadcast side if it has few rows, else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound the Arrow batches that Python workers receive; long texts make 10,000 rows too many."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def column_or_null(df: DataFrame, name: str, kind: T.DataType):
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about ``most_bytes``; a longer text comes alone, whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = offsets_of(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(offsets.searchsorted(offsets[at] + most_bytes, "right")) - 1)
            to = min(to, batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def offsets_of(array: pa.Array):
    import numpy as np

    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind = np.int64 if wide else np.int32
    return np.frombuffer(array.buffers()[1], kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)
