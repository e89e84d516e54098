"""Operator 3: token ids in Arrow stream files of fixed-size-list batches.

Documents are range-partitioned and sorted by id; each partition encodes its
texts, appends the end id to each document, and writes one Arrow IPC stream in
the shared folder. The stream holds the partition's ids packed end to end into
sequences of equal length: column ``input_ids`` (fixed-size list of uint16, or
uint32 for a larger vocabulary) and ``mask`` (fixed-size list of bool, false on
the padding of the last sequence). Equal lengths make position ``p`` sequence
``p // length``, entry ``p % length``, so a memory-mapped file gives any span
as a view without copying. A table beside the files, written by Spark, names
for each document its file, its place there and its number of ids; file names
carry an attempt's own id and only files named in that table count, so lost
executors and repeated attempts leave no wrong data.

Defined results: null and empty texts hold the end id alone; documents with
equal ids are ordered by their text; null ids come first; an empty table
writes no file and reads back empty; other columns are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gainkit.llm.bytesops import text_slices
from gainkit.llm.chunkcache import SPACES, ChunkCache, found, spans
from gainkit.session import Scratch

_INDEX = "file string, pos long, n_tokens long"
_kept: dict = {}
#: chunks that the library gets in one string
JOINED = 250


class LibraryEncoder:
    """Ids by the tokenizers library, distinct chunks once each. Chunks without
    white space, but for a space at their start, are encoded some hundred in one
    string; those that begin with no space get a line break in front. The line
    break's id and tokens whose text begins with the space, which are nowhere
    else in them, mark where each begins."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.size = max(vocab.values()) + 1
        self.opens = np.zeros(self.size, bool)
        self.opens[[i for token, i in vocab.items() if token.startswith("Ġ")]] = True
        # added tokens are found in texts too, and white space before one ends a piece
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        line = self._plain(["\n"])[0]
        self.opens[line[0]] = True
        self.joins = len(line) == 1 and not any(b"\n" in x or b" " in x for x in added)
        self.cache = ChunkCache(self.encode_chunks, uncut=added)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """(ids, where each chunk's ids begin, how many); None if the marks don't fit."""
        line = data[starts] != 0x20
        ends = np.cumsum(sizes + line)
        text = np.full(int(ends[-1]), 0x0A, np.uint8)
        text[np.arange(int(sizes.sum())) + np.repeat(np.cumsum(line), sizes)] = spans(data, starts, sizes)
        raw, edges = text.tobytes(), [0, *ends[JOINED - 1:-1:JOINED].tolist(), len(text)]
        ids = np.fromiter(chain.from_iterable(self._plain([raw[a:b].decode() for a, b in pairwise(edges)])), np.int32)
        at = np.flatnonzero(self.opens[ids])
        if len(at) != len(starts) or at[0]:
            return None
        return ids, at + line, np.diff(at, append=len(ids)) - line

    def encode_chunks(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        apart = SPACES[data]
        for word in self.cache.uncut:
            apart[found(data, word)] = True
        before = np.concatenate(([0], np.cumsum(apart)))
        inner = starts + ((data[starts] == 0x20) & (ends - starts > 1))
        joins = (before[ends] == before[inner]) & self.joins
        ids, at, lens = np.zeros(0, np.int32), np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        if joins.any():
            got = self._joined(data, starts[joins], (ends - starts)[joins])
            if got:
                ids, at[joins], lens[joins] = got
            else:
                joins[:] = False
        if not joins.all():
            raw = data.tobytes()
            rest = self._plain([raw[a:b].decode() for a, b in zip(starts[~joins].tolist(), ends[~joins].tolist(), strict=True)])
            n = np.fromiter(map(len, rest), np.int64, len(rest))
            at[~joins], lens[~joins] = len(ids) + np.cumsum(n) - n, n
            ids = np.concatenate((ids, np.fromiter(chain.from_iterable(rest), np.int32, int(n.sum()))))
        return spans(ids, at, lens), lens


def encoder(path: str) -> LibraryEncoder:
    if _kept.get("path") != path:
        _kept.update(path=path, encoder=LibraryEncoder(path))
    return _kept["encoder"]


class StreamWriter:
    """Packs ids into sequences of ``length`` and writes them batch by batch."""

    def __init__(self, uri: str, length: int, dtype):
        self.fs, path = pafs.FileSystem.from_uri(uri)
        self.length, self.dtype = length, dtype
        kind = pa.list_(pa.from_numpy_dtype(dtype), length)
        self.schema = pa.schema([("input_ids", kind), ("mask", pa.list_(pa.bool_(), length))])
        self.sink = self.fs.open_output_stream(path)
        self.out = pa.ipc.new_stream(self.sink, self.schema)
        self.rest, self.total = np.zeros(0, dtype), 0

    def write(self, ids: np.ndarray, last: bool = False) -> None:
        self.total += len(ids)
        ids = np.concatenate((self.rest, ids.astype(self.dtype)))
        whole = len(ids) // self.length * self.length
        self.rest = ids[whole:]
        self._batch(ids[:whole], whole)
        if last and len(self.rest):
            padded = np.zeros(self.length, self.dtype)
            padded[:len(self.rest)] = self.rest
            self._batch(padded, len(self.rest))

    def _batch(self, ids: np.ndarray, real: int) -> None:
        if len(ids):
            mask = pa.array(np.arange(len(ids)) < real)
            lists = [pa.FixedSizeListArray.from_arrays(v, self.length) for v in (pa.array(ids), mask)]
            self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        self.write(np.zeros(0, self.dtype), last=True)
        self.out.close()
        self.sink.close()


class TokenFile:
    """Random access to one written file; spans are views of the mapped file
    as long as they lie in one batch. Local files are memory-mapped, files of
    other stores are read into memory."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else pa.BufferReader(fs.open_input_file(path).read())
        self.batches = list(pa.ipc.open_stream(source))
        self.length = self.batches[0].schema.field(0).type.list_size if self.batches else 1
        rows = [0, *(b.num_rows for b in self.batches)]
        self.first = np.cumsum(rows) * self.length
        self.ids = [b.column(0).flatten().to_numpy(zero_copy_only=True) for b in self.batches]

    def span(self, pos: int, n: int) -> np.ndarray:
        i = int(np.searchsorted(self.first, pos, side="right")) - 1
        a = pos - int(self.first[i])
        if a + n <= len(self.ids[i]):
            return self.ids[i][a:a + n]
        parts = []
        while n > 0:
            parts.append(self.ids[i][a:a + n])
            n -= len(parts[-1])
            i, a = i + 1, 0
        return np.concatenate(parts)

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``k``."""
        i = int(np.searchsorted(self.first, k * self.length, side="right")) - 1
        row = k - int(self.first[i]) // self.length
        return self.span(k * self.length, self.length), self.batches[i].column(1).slice(row, 1).flatten().to_numpy(zero_copy_only=False)


def write(docs: DataFrame, tokenizer_path: str, scratch: Scratch, end_id: int = 0, length: int = 2048,
          key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and write ``docs``; returns the table of places: key, file,
    pos (in the file), n_tokens (with the end id)."""
    src = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    ordered = src.repartitionByRange(F.col("_key")).sortWithinPartitions("_key", "_text")
    folder = f"{scratch.path}/ids"
    _make_folder(docs.sparkSession, folder)
    schema = T.StructType([T.StructField("_key", src.schema.fields[0].dataType), *T._parse_datatype_string(_INDEX).fields])

    def run(batches):
        enc = encoder(tokenizer_path)
        dtype = np.uint16 if enc.size <= 1 << 16 else np.uint32
        uri, out, pos = f"{folder}/{uuid.uuid4().hex}.arrows", None, 0
        for batch in batches:
            counts = []
            for _, data, offsets in text_slices(batch.column(1)):
                ids, n = enc.cache.encode_slice(data, offsets)
                out = out or StreamWriter(uri, length, dtype)
                out.write(np.insert(ids, np.cumsum(n), end_id))
                counts.append(n + 1)
            if counts:
                n = np.concatenate(counts)
                at = pos + np.cumsum(n) - n
                pos += int(n.sum())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([uri] * len(n)), pa.array(at), pa.array(n)], names=schema.names)
        if out:
            out.close()

    return scratch.cut(ordered.mapInArrow(run, schema).withColumnRenamed("_key", key))


def _make_folder(spark: SparkSession, folder: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def read(places: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document, from the files: key, start (ids of all documents before
    it), n_tokens, ids_crc32 (of the ids as little-endian uint32). One row per
    file, not per document, goes through the window that places the files."""
    files = places.groupBy("file").agg(F.sum("n_tokens").alias("_n"), F.min(key).alias("_k"))
    base = files.select("file", (F.coalesce(F.sum("_n").over(
        Window.orderBy(F.col("_k").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_base"))
    cols = places.select(F.col(key), "file", "pos", "n_tokens")
    schema = T.StructType([*cols.schema.fields, T.StructField("ids_crc32", T.LongType())])

    def run(batches):
        name, opened = None, None
        for batch in batches:
            crc = []
            for f, p, n in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                if f != name:
                    name, opened = f, TokenFile(f)
                crc.append(zlib.crc32(opened.span(p, n).astype("<u4")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(crc, pa.int64())], names=schema.names)

    return cols.mapInArrow(run, schema).join(base, "file").select(key, (F.col("_base") + F.col("pos")).alias("start"), "n_tokens", "ids_crc32")
