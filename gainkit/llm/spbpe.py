"""Operator 6: byte-level BPE encoding and decoding with sentencepiece.

A rank file (base64 token, rank per line) becomes a serialised sentencepiece
BPE model: every token's bytes are written with one printable character per
byte, the piece's score is its negative rank (so the lowest rank merges first,
the leftmost on ties), the normaliser is the identity and no space is added,
removed or escaped. Piece ids are the ranks. Texts are cut into pre-tokens by
the pattern, each is encoded on its own, and decoding maps ids back to bytes.
The model is built once per Python worker from the vocabulary's path.

Defined results: null and empty texts give no ids, 0 tokens and empty bytes;
texts of any length are encoded whole; repeated rows each give their row; an
empty table gives an empty table; other columns are not touched.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gainkit.llm.bytesops import text_slices
from gainkit.llm.chunkcache import ChunkCache

_SCHEMA = T.StructType([T.StructField("_n", T.LongType()), T.StructField("_ids", T.BinaryType())])
_kept: dict = {}


def byte_characters() -> list[str]:
    """One printable character per byte: bytes that print as themselves in
    Latin-1 stand for themselves, the others take code points from 256 up."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {b: chr(b) for b in own}
    for b in range(256):
        out.setdefault(b, chr(256 + b - sum(x < b for x in own)))
    return [out[b] for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def serialise(tokens: list[bytes]) -> bytes:
    """The sentencepiece model of the vocabulary, pieces numbered by rank; the
    unknown piece, which no byte-mapped text can reach, comes last."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    chars = byte_characters()
    model = pb.ModelProto()
    for rank, token in enumerate(tokens):
        model.pieces.add(piece="".join(chars[b] for b in token), score=-float(rank), type=1)
    model.pieces.add(piece="<unk>", score=0.0, type=2)
    t, n = model.trainer_spec, model.normalizer_spec
    t.model_type, t.vocab_size, t.unk_id, t.bos_id, t.eos_id, t.pad_id = 2, len(model.pieces), len(tokens), -1, -1, -1
    n.name, n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces = "identity", False, False, False
    return model.SerializeToString()


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece
        self.tokens = read_ranks(path)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.tokens))
        self.pattern = regex.compile(pattern)
        self.chars = byte_characters()
        self.cache = ChunkCache(self.encode_chunks)

    def pieces_of(self, pre_tokens: list[str]) -> list[list[int]]:
        """Ids of each pre-token, encoded separately."""
        table = {i: c for i, c in enumerate(self.chars)}
        mapped = [p.encode().decode("latin-1").translate(table) for p in pre_tokens]
        return self.processor.encode(mapped, num_threads=1)

    def encode_chunks(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        cut = [self.pattern.findall(raw[a:b].decode()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        distinct = list(dict.fromkeys(chain.from_iterable(cut)))
        ids = dict(zip(distinct, self.pieces_of(distinct), strict=True))
        rows = [[i for p in parts for i in ids[p]] for parts in cut]
        lens = np.fromiter(map(len, rows), np.int64, len(rows))
        return np.fromiter(chain.from_iterable(rows), np.int32, int(lens.sum())), lens

    def decode(self, ids) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


def codec(path: str, pattern: str) -> Codec:
    if _kept.get("at") != (path, pattern):
        _kept.update(at=(path, pattern), codec=Codec(path, pattern))
    return _kept["codec"]


def map_ids(batches, path, pattern, text_at, make):
    """For each batch, ``make(batch, list of id arrays of its rows)``."""
    c = codec(path, pattern)
    for batch in batches:
        rows: list[np.ndarray] = []
        for _, data, offsets in text_slices(batch.column(text_at)):
            ids, counts = c.cache.encode_slice(data, offsets)
            ends = np.cumsum(counts)
            rows += [ids[e - k:e] for e, k in zip(ends.tolist(), counts.tolist(), strict=True)]
        yield make(c, batch, rows)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """The rows of ``docs`` with their ids (array of int) in a new column
    ``out``, which replaces a column of that name."""
    docs = docs.drop(out)
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def make(_, batch, rows):
        lens = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lens))), pa.int32()), pa.array(flat))
        return pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, out])

    return docs.mapInArrow(lambda it: map_ids(it, path, pattern, at, make), schema)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """The rows of ``encoded`` with the bytes that their ids stand for."""
    encoded = encoded.drop(out)
    at = encoded.columns.index(ids)
    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            got = [None if x is None else c.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.binary())], names=[*batch.schema.names, out])

    return encoded.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_tokens, sha256 of the decimal ids joined by one space,
    and sha256 of the bytes decoded from the ids, in one pass over the texts."""
    src = docs.select(F.col(key), F.col(text).alias("_text"))
    schema = T.StructType([src.schema.fields[0], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def make(c, batch, rows):
        size = len(c.tokens)
        if ("names", size) not in _kept:
            _kept["names", size] = [str(i) for i in range(size)]
        names = _kept["names", size]
        a, b, n = [], [], []
        for ids in rows:
            ids = ids.tolist()
            n.append(len(ids))
            a.append(hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest())
            b.append(hashlib.sha256(c.decode(ids)).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                          names=schema.names)

    return src.mapInArrow(lambda it: map_ids(it, path, pattern, 1, make), schema)
