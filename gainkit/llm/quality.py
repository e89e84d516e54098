"""Operator 8: line-first cleaning and quality rules.

Each line that has a word is judged on its own; failing lines go, and a
document goes when more than ``MAX_LOST`` of its words went with them (or when
it fails the base rules). The line rules:

* symbols: more than ``SYMBOLS`` of ``#*$%&|<>`` for each word;
* navigation: separators (``| > »`` and the like) between at least a fifth of the words;
* shouting: double exclamation marks after more than a third of the words;
* boilerplate: a short line with one of the phrases below;
* punctuation: a long line without one sentence mark for every ``WORDS_PER_MARK`` words
  that does not end in one either.

Base rules: fewer than 20 words, or more than 30 % of the words in 8-word
windows that the text holds twice or more.

Work is over slices of documents as byte arrays (``bytesops``); windows and
lines are compared by 64-bit hashes of their content within one document.

Defined results: null and empty texts have no words and fail; lines without a
word are never judged and stay; repeated rows each give their row; texts of
any length are read whole; an empty table gives an empty one; ``clean`` keeps
every column.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gainkit.llm.bytesops import SPACE, chain, owner, prefix_hash, runs, span_hash, text_slices

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = 0.3
MAX_LOST = 0.3
WORDS_PER_MARK = 60
SHORT_LINE = 30

# Symbols of the contract, sentence marks, boilerplate phrases.
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".!?:;")] = True
_CLOSER = np.zeros(256, bool)
_CLOSER[list(b"\"')]")] = True
_WIDE_MARKS = ("…", "。", "！", "？")
BOILERPLATE = re.compile(
    rb"all rights reserved|cookie policy|uses cookies|accept cookies|privacy policy|terms of (?:use|service)"
    rb"|enable javascript|click here|read more|subscribe to|sign up|log in|share this|back to top"
    rb"|licensed under|released under the|this work is licensed", re.IGNORECASE)

FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bad_lines", "lost_words")


def _per_doc(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _twice(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: whether its (doc, hash) occurs twice or more, and whether
    an earlier item has it."""
    order = np.lexsort((np.arange(len(h)), h, doc))
    d, x = doc[order], h[order]
    same = np.zeros(len(h), bool)
    same[1:] = (d[1:] == d[:-1]) & (x[1:] == x[:-1])
    twice = same.copy()
    twice[:-1] |= same[1:]
    out, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    out[order], later[order] = twice, same
    return out, later


def measure_slice(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The figures of each document and, for each byte, whether it stays."""
    n_docs = len(offsets) - 1
    space = SPACE[data]
    h = prefix_hash(data)
    w_start, w_end = runs(~space, offsets)
    w_doc = owner(w_start, offsets)
    code = span_hash(data, h, w_start, w_end)
    out = {"n_words": np.bincount(w_doc, minlength=n_docs)}
    out["word_chars"] = _per_doc(~space & ((data & 0xC0) != 0x80), offsets)
    symbol = _SYMBOL[data]
    out["n_symbols"] = _per_doc(symbol, offsets)

    windows = max(0, len(code) - WINDOW + 1)
    covered = np.zeros(len(code) + 1, np.int64)
    if windows:
        inside = np.flatnonzero(w_doc[:windows] == w_doc[WINDOW - 1:])
        twice, _ = _twice(w_doc[inside], chain(code, WINDOW)[inside])
        at = inside[twice]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(w_doc, weights=np.cumsum(covered)[:-1] > 0, minlength=n_docs).astype(np.int64)

    feed = data == 0x0A
    l_start = np.unique(np.concatenate((offsets[:-1], np.flatnonzero(feed) + 1)))
    l_start = l_start[l_start < len(data)]
    l_next = np.append(l_start[1:], len(data))
    l_end = l_next - feed[l_next - 1] if len(l_start) else l_next
    l_words = np.bincount(np.searchsorted(l_start, w_start, side="right") - 1, minlength=len(l_start))
    with_word = np.flatnonzero(l_words)
    l_start, l_next, l_end, l_words = l_start[with_word], l_next[with_word], l_end[with_word], l_words[with_word]
    l_doc = owner(l_start, offsets)
    _, dup = _twice(l_doc, span_hash(data, h, l_start, l_end))
    out["n_dup_lines"] = np.bincount(l_doc, weights=dup, minlength=n_docs).astype(np.int64)

    bad = _bad_lines(data, symbol, w_start, w_end, l_start, l_end, l_words)
    out["n_lines"] = np.bincount(l_doc, minlength=n_docs)
    out["n_bad_lines"] = np.bincount(l_doc, weights=bad, minlength=n_docs).astype(np.int64)
    out["lost_words"] = np.bincount(l_doc, weights=bad * l_words, minlength=n_docs).astype(np.int64)
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, l_start[bad], 1)
    np.add.at(edge, l_next[bad], -1)
    return out, np.cumsum(edge)[:-1] == 0


def _bad_lines(data, symbol, w_start, w_end, l_start, l_end, l_words) -> np.ndarray:
    if not len(l_start):
        return np.zeros(0, bool)

    def count(mask):
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[l_end] - total[l_start]

    symbols = count(symbol)
    bad = symbols > SYMBOLS * l_words
    quote = data == 0xBB  # the last byte of », but of û and others too
    quote[1:] &= data[:-1] == 0xC2
    separators = count((data == ord("|")) | (data == ord(">")) | quote)
    bad |= (separators >= 3) & (separators >= 0.2 * l_words)
    bang = data == ord("!")
    double = np.zeros(len(data), bool)
    double[1:] = bang[1:] & bang[:-1]
    bad |= (count(double) > l_words / 3) & (l_words >= 3)

    marks = count(_MARK[data])
    last_word = np.searchsorted(w_start, l_end, side="left") - 1
    last = w_end[last_word] - 1
    before = np.maximum(last - 1, 0)
    ends = _MARK[data[last]] | (_CLOSER[data[last]] & _MARK[data[before]])
    loose = np.flatnonzero(~ends & (l_words > WORDS_PER_MARK) & (marks * WORDS_PER_MARK < l_words))
    raw = data.tobytes()
    for i in loose.tolist():
        bad[i] |= not any(m in raw[l_start[i]:l_end[i]].decode(errors="replace") for m in _WIDE_MARKS)

    for hit in BOILERPLATE.finditer(raw):
        i = int(np.searchsorted(l_start, hit.start(), side="right")) - 1
        if i >= 0 and hit.end() <= l_end[i] and l_words[i] <= SHORT_LINE:
            bad[i] = True
    return bad


def verdict(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept)."""
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"])
    return failed, ~failed & (m["lost_words"] <= MAX_LOST * m["n_words"])


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: the figures, base_failed and kept."""
    src = docs.select(F.col(key), F.col(text).alias("_text"))
    schema = T.StructType([src.schema.fields[0], *[T.StructField(f, T.LongType()) for f in FIELDS],
                           T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])

    def run(batches):
        for batch in batches:
            for i, data, offsets in text_slices(batch.column(1)):
                m, _ = measure_slice(data, offsets)
                rest = [pa.array(m[f].astype(np.int64)) for f in FIELDS] + [pa.array(x) for x in verdict(m)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(offsets) - 1), *rest], names=schema.names)

    return src.mapInArrow(run, schema)


def clean(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The kept documents, without their failing lines; ``length``, where
    there is such a column, becomes the new number of code points."""
    schema, names = docs.schema, docs.columns
    at = names.index(text)
    fixed = names.index(length) if length in names else None
    to_arrow = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32()}
    kind = to_arrow.get(schema.fields[fixed].dataType) if fixed is not None else None

    def run(batches):
        for batch in batches:
            for i, data, offsets in text_slices(batch.column(at)):
                m, stays = measure_slice(data, offsets)
                kept = np.flatnonzero(verdict(m)[1])
                ends = np.concatenate(([0], np.cumsum(stays)))[offsets]
                left = data[stays].tobytes()
                texts = [left[ends[k]:ends[k + 1]].decode() for k in kept.tolist()]
                part = pa.Table.from_batches([batch]).slice(i, len(offsets) - 1).take(pa.array(kept))
                part = part.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                if kind is not None:
                    part = part.set_column(fixed, batch.schema.field(fixed), pa.array([len(x) for x in texts], kind))
                yield from part.combine_chunks().to_batches()

    return docs.mapInArrow(run, schema)
