"""Operator 13: ranked lexical search by the Best Position Algorithm.

Terms are runs of ASCII letters, digits and everything outside ASCII, A-Z in
lower case. A document's score for an item sums, over the item's terms with
repeats, an integer impact of (term, document): a weight of the term's document
frequency times a saturated term frequency, normalised by document length.

The items are taken in blocks of bounded size. For a block the corpus is read
once into a forward index that holds the block's terms only: document, length,
terms and frequencies, written as a table. Counts of documents, terms and
document frequencies come from it. The search then runs in every task over
shards of at most ``SHARD`` postings. A shard has a list for each term, sorted
by falling impact. An item reads its lists a few positions at a time; each new
document is completed by direct accesses to the item's other lists, which also
marks its positions there as seen. A list's best position is the last one up to
which all have been seen. No unseen document can score more than the sum of the
impacts at the best positions, so the item is done as soon as that sum is
strictly below its k-th best score: equal scores are still told apart by id.
The k-th score of a task's earlier shards counts as well. What the shards found
is cut to k rows for each item in each task before it is shuffled.

Defined results: null texts have no terms; documents without terms are not
counted; items without terms and items that meet no document return nothing;
every row of ``docs`` is a document, equal ids rank one after the other, null
ids after others of the same score; equal rows of ``items`` are one item, items
with the same id and other texts are ranked each; other columns are ignored;
empty tables give an empty one.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gainkit.session import Scratch

TOP = 10
BLOCK_CHARS = 8_000_000     # characters of items that are searched for at once
SHARD = 2_000_000           # postings in one set of impact lists
STEP = 32                   # positions read of each list at first
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def forward(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of (doc_id, text): every document with a term,
    its number of terms, and which terms of the vocabulary it holds how often."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)     # of a block of items

    def run(batches):
        index = sent.value
        for batch in batches:
            rows, size, ends, at, tf = [], [], [0], [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                words = terms(text or b"")
                if words:
                    own = sorted((index[w], c) for w, c in Counter(words).items() if w in index)
                    at += [t for t, _ in own]
                    tf += [c for _, c in own]
                    rows.append(i)
                    size.append(len(words))
                    ends.append(len(at))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows, pa.int64())), pa.array(size, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(at, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32()))],
                names=["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, terms array<int>, tfs array<int>")


class Lists:
    """The impact lists of some documents, with direct access by document."""

    def __init__(self, starts: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        self.starts, self.term, self.impact = starts, term, impact
        doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        order = np.lexsort((-impact, term))
        self.doc, self.sorted = doc[order], impact[order]     # by term, falling impact
        self.place = np.empty(len(order), np.int64)           # of a document's posting in the lists
        self.place[order] = np.arange(len(order))
        self.begin = np.searchsorted(term[order], np.arange(n_terms + 1))

    def top(self, wanted: np.ndarray, times: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that hold all of the k best with a score of at
        least ``floor`` and above 0, ties included. ``times``: how often the
        item holds the term."""
        some = self.begin[wanted + 1] > self.begin[wanted]
        wanted, times = wanted[some], times[some]
        begin, end = self.begin[wanted], self.begin[wanted + 1]
        often = np.zeros(len(self.begin), np.int64)
        often[wanted] = times
        best, seen = begin.copy(), np.zeros(len(self.place), bool)     # before best: all seen
        known = np.zeros(len(self.starts) - 1, bool)
        docs, scores, depth, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, STEP
        while len(wanted):
            read = [self.doc[a + depth:min(a + depth + step, b)] for a, b in zip(begin, end)]
            found = np.unique(np.concatenate(read))
            found = found[~known[found]]
            known[found] = True
            # direct accesses: all postings of the new documents
            length = self.starts[found + 1] - self.starts[found]
            edge = np.concatenate([[0], np.cumsum(length)])
            post = np.repeat(self.starts[found] - edge[:-1], length) + np.arange(edge[-1])
            seen[self.place[post]] = True
            run = np.concatenate([[0], np.cumsum(often[self.term[post]] * self.impact[post])])
            docs, scores = np.concatenate([docs, found]), np.concatenate([scores, run[edge[1:]] - run[edge[:-1]]])
            if len(scores) >= k:
                floor = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                stay = scores >= floor
                docs, scores = docs[stay], scores[stay]
            for i, (b, e) in enumerate(zip(best, end)):
                rest = seen[b:e]
                best[i] = e if rest.all() else b + int(rest.argmin())
            open_ = best < end
            if not open_.any() or int((times * self.sorted[best - 1])[open_].sum()) < floor:
                break
            depth += step
            step *= 2
        stay = (scores >= floor) & (scores > 0)
        return docs[stay], scores[stay]


def shards(batches, most: int):
    """Batches joined or cut to tables of at most ``most`` postings, or of one
    document."""
    held, room = [], most
    for batch in batches:
        ends = batch.column(2).offsets.to_numpy()[1:].astype(np.int64)
        at, before = 0, int(batch.column(2).offsets[0].as_py())
        while at < len(ends):
            to = int(np.searchsorted(ends, before + room, side="right"))
            if to <= at and held:
                yield pa.Table.from_batches(held)
                held, room = [], most
                continue
            to = max(to, at + 1)
            held.append(batch.slice(at, to - at))
            room, at, before = room - (int(ends[to - 1]) - before), to, int(ends[to - 1])
            if room <= 0:
                yield pa.Table.from_batches(held)
                held, room = [], most
    if held:
        yield pa.Table.from_batches(held)


def lists_of(table: pa.Table, weights: np.ndarray, n_docs: int, n_terms: int) -> Lists:
    """The impact lists of rows of the forward index."""
    where = table.column(2).combine_chunks()
    term, tf = where.flatten().to_numpy(), table.column(3).combine_chunks().flatten().to_numpy().astype(np.int64)
    m = np.array([100 - 75 + 75 * n * n_docs // n_terms for n in table.column(1).to_pylist()], np.int64)
    starts = where.offsets.to_numpy().astype(np.int64)
    impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(starts))))
    return Lists(starts - starts[0], term, impact, len(weights))


def search(index: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): rows among which are each item's k best, from the
    forward index of all documents. ``items``: terms and how often, ascending."""
    sent = index.sparkSession.sparkContext.broadcast((items, weights))   # of a block of items

    def run(batches):
        asked, w = sent.value
        floors = [np.zeros(0, np.int64) for _ in asked]       # each item's k best scores of the task so far
        for table in shards(batches, SHARD):
            table = table.take(pc.sort_indices(table.column(0), null_placement="at_end"))
            ids, lists = table.column(0).combine_chunks(), lists_of(table, w, n_docs, n_terms)
            for i, (at, times) in enumerate(asked):
                docs, scores = lists.top(at, times, k, int(floors[i][0]) if len(floors[i]) == k else 0)
                if len(docs):
                    order = np.lexsort((docs, -scores))[:k]
                    docs, scores = docs[order], scores[order]
                    floors[i] = np.sort(np.concatenate([floors[i], scores]))[-k:]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), i)), ids.take(pa.array(docs)), pa.array(scores)],
                                                     names=["item", "doc_id", "score"])

    return index.mapInArrow(run, f"item long, doc_id {index.schema['doc_id'].dataType.simpleString()}, score long")


def ranked(docs: DataFrame, items: DataFrame, scratch: Scratch, k: int = TOP, key: str = "doc_id", item_key: str = "item_id", text: str = "text",
           block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest
    scores above 0 for each item, equal scores by ascending id."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    items = items.select(F.col(item_key).alias("item_id"), F.col(text).alias("text")).distinct()
    chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = -(-chars // block_chars)
    out = [spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")]
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()   # about block_chars
        words = [Counter(terms((r["text"] or "").encode())) for r in part]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*words)))}
        index = scratch.cut(forward(docs, vocabulary))
        n_docs, n_terms = index.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = np.zeros(len(vocabulary))
        for t, n in index.select(F.explode("terms").alias("t")).groupBy("t").count().collect():     # of the vocabulary
            df[t] = n
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        asked = [tuple(np.array(x, np.int64) for x in zip(*sorted((vocabulary[t], c) for t, c in w.items()))) or (np.zeros(0, np.int64),) * 2 for w in words]
        found = search(index, asked, weights, n_docs, n_terms or 1, k)
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        best = found.withColumn("rank", place).filter(F.col("rank") <= k)
        named = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(part)], f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
        out.append(best.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionAll, out)
