"""Token ids in Arrow files of fixed-size lists: equal-length sequences and masks, open to random access.

Documents are range-partitioned by id; each task streams its texts through the tokenizer and writes
one Arrow IPC file of record batches with two columns, ``input_ids`` (fixed-size list of ``length``
ids, 16 bits wide where the vocabulary allows) and ``mask`` (as many booleans; false only behind the
last token of a file). Beside it lies an Arrow file of document places. Sequences are a plain cut of
the file's token stream, so a memory-mapped reader gets sequence ``k`` without copying or decoding.

A task names its files after its attempt and reports them in a manifest row; a retried task leaves
at most an unnamed file behind. Files go through ``pyarrow.fs`` to the folder that all executors share.

Defined results: a null text is an empty one (only the end id); ids are in ascending ``doc_id``
order, nulls first, equal ids by text; repeated rows are separate documents; an empty table gives no
files; a text is tokenized whole, however long; a special token's string in a text is that token, as the
plain call of the tokenizer has it; columns beside ``doc_id`` and ``text``, whatever their names, are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmark.llm.common import column_or_null, map_arrow, new_path, written

LENGTH, SEQUENCES, END_ID, CACHE = 1024, 64, 0, 1_800_000

_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_MANIFEST = "part int, file string, n_docs long, n_ids long, n_sequences long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Exact ids of whole texts.

    The pre-tokenizer of a byte-level BPE cuts before every single space and around every single line
    break, and no merge crosses a cut. So where a text has no longer runs of white space, its ids are
    those of its words in turn, each with the space before it; words seen lately keep theirs. Other
    texts, and those that hold a special token's string, go through the tokenizer as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))).search if special else lambda t: None
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.line_break = self.encode(["\n"])[0]
        self.marks = dict(zip(",.", self.encode([",", "."]), strict=True))
        self.known: dict[str, bytes] = {"\n": self.line_break}

    def encode(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each word, many words a call: a line break is one id that no word holds."""
        size, stop = len(self.line_break), np.frombuffer(self.line_break, self.code)[0]
        for at in range(0, len(words), 2000):
            flat = self.encode(["\n".join(words[at : at + 2000])])[0]
            ends = (np.flatnonzero(np.frombuffer(flat, self.code) == stop) * size).tolist()
            for b, e in zip([0, *(e + size for e in ends)], [*ends, len(flat)], strict=True):
                yield flat[b:e]

    def _learn(self, words: set[str]) -> None:
        if len(self.known) > CACHE:
            self.known = {"\n": self.line_break}
        known, whole, cut = self.known, [], []
        for w in words:
            # a word of letters and one mark is two pre-tokens
            (cut if w[-1] in ",." and w[:-1].lstrip(" ").isalpha() else whole).append(w)
        whole += list({w[:-1] for w in cut if w[:-1] not in known and w[:-1] not in words})
        known.update(zip(whole, self._words(whole), strict=True))
        for w in cut:
            if w[:-1] not in known:
                known[w[:-1]] = next(self._words([w[:-1]]))
            known[w] = known[w[:-1]] + self.marks[w[-1]]

    def __call__(self, texts: list[str]) -> list[bytes]:
        # every word with the space before it, and line breaks
        words = [t.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") if _plain(t) and not self.special(t) else None for t in texts]
        get = self.known.get
        ids = [w and list(map(get, w)) for w in words]
        gaps = [[k for k, g in enumerate(gs) if g is None] if gs and None in gs else () for gs in ids]
        new = {ws[k] for ws, own in zip(words, gaps, strict=True) for k in own}
        if new:
            self._learn(new)
            for ws, gs, own in zip(words, ids, gaps, strict=True):
                for k in own:
                    gs[k] = self.known[ws[k]]
        other = iter(self.encode([t for t, w in zip(texts, words, strict=True) if w is None]))
        return [next(other) if gs is None else b"".join(gs) for gs in ids]


#: White space that is not one space or line break between other characters.
_OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search


def _plain(t: str) -> bool:
    """Whether the white space of ``t`` is one space or line break each time, between other characters, and it has no zeros."""
    return not (not t or t[0] in " \n" or t[-1] in " \n" or "  " in t or "\n\n" in t or " \n" in t or "\n " in t or "\0" in t or _OTHER_SPACE(t))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker; workers are used again, and so are the words they know."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _sink(folder: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    return system, path


class _Writer:
    """Cuts a stream of ids into sequences and writes them in batches."""

    def __init__(self, sink, kind: np.dtype, length: int):
        self.length, self.kind, self.waiting, self.held = length, kind, [], 0
        ids = pa.list_(pa.from_numpy_dtype(kind), length)
        self.schema = pa.schema([("input_ids", ids), ("mask", pa.list_(pa.bool_(), length))])
        self.file = pa.ipc.new_file(sink, self.schema)
        self.n_ids = self.n_sequences = 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        self.n_ids += len(ids)
        if self.held >= self.length * SEQUENCES * 4:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.kind)
        block = self.length * SEQUENCES
        full = len(flat) if last else len(flat) // block * block
        for at in range(0, full, block):
            part = flat[at : at + block]
            n = -(-len(part) // self.length)
            ids = np.zeros(n * self.length, self.kind)
            ids[: len(part)] = part
            mask = np.arange(n * self.length) < len(part)
            arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
            self.file.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))
            self.n_sequences += n
        self.waiting, self.held = ([flat[full:]], len(flat) - full) if full < len(flat) else ([], 0)

    def close(self) -> None:
        self._flush(True)
        self.file.close()


def write_token_files(docs: DataFrame, folder: str | None = None, vocabulary: Callable[[], str] = default_vocabulary, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` (doc_id, text) as token files below ``folder``; returns the manifest, a row a file."""
    folder = folder or new_path(docs.sparkSession, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encode, writer, places = TaskContext.get(), None, None, None
        n_docs = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encode = encoder(vocabulary())
                system, path = _sink(folder)
                name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
                kind = np.dtype("uint16" if encode.code == "H" else "uint32")
                sinks = [system.open_output_stream(f"{path}/{name}.{x}arrow") for x in ("", "docs.")]
                writer, places = _Writer(sinks[0], kind, length), pa.ipc.new_file(sinks[1], _DOCS)
                end = np.array([end_id], kind).tobytes()
            found = encode(["" if t is None else t for t in batch.column(1).to_pylist()])
            counts = np.array([len(ids) // kind.itemsize + 1 for ids in found], np.int64)
            starts = writer.n_ids + np.cumsum(counts) - counts
            writer.add(np.frombuffer(end.join(found) + end, kind))
            places.write_batch(pa.RecordBatch.from_arrays([batch.column(0), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())], schema=_DOCS))
            n_docs += batch.num_rows
        if writer is not None:
            writer.close()
            places.close()
            for s in sinks:
                s.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "file": [f"{folder}/{name}"], "n_docs": [n_docs], "n_ids": [writer.n_ids], "n_sequences": [writer.n_sequences]})

    ordered = (
        docs.select(column_or_null(docs, "doc_id", T.LongType()).alias("doc_id"), column_or_null(docs, "text", T.StringType()).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return written(map_arrow(ordered, run, _MANIFEST), "manifest")


def open_sequences(file: str, memory_map: bool = True) -> pa.ipc.RecordBatchFileReader:
    """The sequences of one file; batches of a local file are views of the mapped memory."""
    system, path = fs.FileSystem.from_uri(f"{file}.arrow")
    local = memory_map and isinstance(system, fs.LocalFileSystem)
    return pa.ipc.open_file(pa.memory_map(path) if local else system.open_input_file(path))


def sequence(reader: pa.ipc.RecordBatchFileReader, k: int) -> np.ndarray:
    """Ids of sequence ``k`` of a file, without copying where the file is mapped."""
    column = reader.get_batch(k // SEQUENCES).column(0)
    size = column.type.list_size
    return column.values.to_numpy(zero_copy_only=True)[column.offset * size + k % SEQUENCES * size :][:size]


def _digests(file: str) -> Iterator[tuple[pa.Array, list[int], list[int], list[int]]]:
    reader = open_sequences(file)
    system, path = fs.FileSystem.from_uri(f"{file}.docs.arrow")
    block, at, ids = -1, 0, np.zeros(0, np.uint16)  # number, first id and ids of the batch at hand
    with system.open_input_file(path) as raw:
        places = pa.ipc.open_file(raw)
        for b in range(places.num_record_batches):
            batch = places.get_batch(b)
            sums = []
            for start, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                crc, place, end = 0, start, start + n
                while place < end:
                    while place >= at + len(ids):
                        at += len(ids)
                        block += 1
                        read = reader.get_batch(block)
                        ids = read.column(0).values.to_numpy()[: int(read.column(1).values.true_count)]
                    part = ids[place - at : end - at]
                    crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                    place += len(part)
                sums.append(crc)
            yield batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), sums


def read_token_files(manifest: DataFrame) -> DataFrame:
    """A row per document of the files that ``manifest`` names, made from their ids."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over the files, a row each
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    n = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for ids, starts, counts, sums in _digests(row["file"]):
                    starts = pa.array(np.asarray(starts, np.int64) + row["before"])
                    yield pa.RecordBatch.from_arrays([ids, starts, pa.array(counts, pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_arrow(placed.select("file", "before").repartition(n), run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet")))
