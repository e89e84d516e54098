"""Operators 11, 12 and 13 against plain statements."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gainkit.llm import codes, lexical, linededup, queries
from gainkit.session import Scratch
from tests.conftest import SF0001
from tests.llm import plain
from tests.llm.conftest import ODD

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
                        T.StructField("id", T.StringType()), T.StructField("q", T.StringType()), T.StructField("code", T.LongType()), T.StructField("ok", T.LongType())])


def docs_of(spark, sf=SF0001):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def by_text(rows):
    """Rows with nulls in order."""
    return sorted(map(tuple, rows), key=repr)


# --- vector codes -----------------------------------------------------------

def check_codes(got, rows):
    want, by_label, books = plain.vector_codes(rows)
    assert by_text((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == \
        by_text((rows[n][0], code, error, by_label[rows[n][2]], books) for n, (code, error) in want.items())


def test_codes(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()]
    check_codes(queries.op11_code_compression(spark, SF0001).collect(), rows)


def compressed(spark, rows, partitions=3):
    df = spark.createDataFrame([(*r, "x", "y", 1, 0) for r in rows], VECTORS).repartition(partitions)
    with Scratch(spark, "t") as scratch:
        return codes.compress(df, scratch).collect()


def test_codes_on_odd_rows(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.randrange(-2, 3) / 4096 for _ in range(16)], i % 3 or None) for i in range(60)]      # ties everywhere
    rows += [(None, [0.5] * 16, 1), (7, [0.25] * 16, None), (7, [0.125] * 16, 2), rows[0], rows[0],
             (90, None, 1), (91, [0.1, None], 1), (92, [float("nan")] * 16, 1), (93, [float("inf")] * 16, 2),
             (94, [], 5), (95, [1.0, -1.0, 0.3], 5), (96, [0.0] * 16, 5)]
    got = compressed(spark, rows)
    assert by_text(got) == by_text(compressed(spark, rows, 7))
    check_codes(got, rows)


def test_codes_of_few_or_no_rows(spark):
    few = [(i, [i / 10, -i / 7] * 4, 1) for i in range(5)]
    check_codes(compressed(spark, few), few)
    assert compressed(spark, [(1, None, 1)]) == [] and compressed(spark, []) == []
    check_codes(compressed(spark, [(1, [], 1)]), [(1, [], 1)])
    with pytest.raises(ValueError, match="too large"):
        compressed(spark, [(1, [1e30], 1)])


def test_search_outward_is_exact_and_stops():
    rnd = np.random.default_rng(4)
    for spread, d in ((2, 3), (5, 1), (4000, 8), (0, 4)):
        entries, x = rnd.integers(-spread, spread + 1, (16, d)), rnd.integers(-spread, spread + 1, (300, d))
        index, best = codes.Book(entries).nearest(x)
        far = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (index == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()


def test_codes_decode_near_their_vectors(spark):
    vectors = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    q = codes.kept(vectors)
    books = codes.fit(q)
    full = {r.vec_id: r.embedding for r in vectors.collect()}
    for r in codes.encode(q, books).limit(50).collect():
        off = np.floor(np.array(full[r.id]) * codes.SCALE) / codes.SCALE - codes.decode(r.code, books)
        assert round((off**2).sum() * codes.SCALE**2) == r.error


# --- lines ------------------------------------------------------------------

def dropped(docs, spark, **options):
    with Scratch(spark, "t") as scratch:
        d = linededup.deduplicate(docs, scratch, **options)
        return by_text(d.select("_doc.doc_id", "_lines", "_dropped", F.sha2("_text", 256)).collect())


def test_lines(spark):
    docs = docs_of(spark)
    want = by_text(plain.line_dedup(docs))
    assert by_text((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in queries.op12_line_dedup(spark, SF0001).collect()) == want
    assert any(x[2] for x in want)


COMMON = "  This line is in Many documents \t"
LINES = [(i, f"own line of document {i}\n{COMMON}\nÉcole THE same ÑANDÚ line İ Ⅷ\n{COMMON.strip().upper()}") for i in range(20, 40)] + [
    (40, "this line is in many documents"), (41, "École the same ÑandÚ line İ Ⅷ"), (42, "école the same ñandú line i̇ ⅷ"),
    (50, "exactly twenty chars\nnineteen characters"), (51, "Exactly Twenty Chars\nnineteen characters"), (52, "exactly twenty chars\nnineteen characters\n"),
    (53, "a line that is found twice only"), (54, "a line that is found twice only"),
    (None, COMMON), (None, COMMON), (None, "only in null ids, three times over"), (None, "only in null ids, three times over\n"), (None, "only in null ids, three times over"),
    (60, "one id three times, other texts 1\nsame id same line again"), (60, "one id three times, other texts 2\nsame id same line again"), (60, "same id same line again"),
    (61, COMMON), (61, COMMON), (61, f"{COMMON}\n{COMMON}\nlast"), (62, "\n\n"), (63, "\r\n" * 5), (64, f"{COMMON}\r\n" * 3000)]


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_lines_on_odd_rows(spark, make_docs, batches):
    docs = ODD + LINES
    assert dropped(make_docs(docs), spark, batches=batches) == by_text(plain.line_dedup(docs))


def test_lines_of_an_empty_table_and_whole_rows(spark, make_docs):
    assert dropped(make_docs([]), spark) == []
    with Scratch(spark, "t") as scratch:
        got = linededup.clean(make_docs(LINES), scratch)
        assert got.columns == make_docs([]).columns
        assert {(r.doc_id, r.id, r.key) for r in got.collect()} == {(i, "x", 1) for i, _ in LINES}


def test_runs_leave_out_what_is_settled(spark):
    rows = lambda *x: spark.createDataFrame(list(x), "h1 long, h2 long, n long, top long")
    with Scratch(spark, "t") as scratch:
        runs = linededup.Runs(spark, scratch)
        runs.add(rows((1, 1, 3, 50), (2, 2, 2, 40)))
        runs.add(rows((1, 1, 9, 50), (2, 2, 1, 60), (3, 3, 1, None)))
        assert list(runs.levels) == [1]
        assert {tuple(r) for r in spark.table(runs.levels[1]).collect()} == {(1, 1, 3, 50), (2, 2, 3, 60), (3, 3, 1, None)}
        runs.add(rows((1, 1, 1, 51), (2, 2, 1, 10)))      # a larger id is news
        assert sorted(runs.levels) == [0, 1]
        assert {tuple(r) for r in runs.common().collect()} == {(1, 1, 51), (2, 2, 60)}
        names = list(runs.levels.values())
        runs.close()
        assert not any(spark.catalog.tableExists(n) for n in names)


def test_lines_run_no_python(spark):
    plan = queries.op12_line_dedup(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


# --- search -----------------------------------------------------------------

def test_search(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").select("item_id", "text").collect()]
    got = queries.op13_lexical_search(spark, SF0001).collect()
    assert by_text((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == by_text(plain.lexical(docs_of(spark), items))


ITEMS = [(1, "one Two two words"), (2, None), (3, ""), (4, "  \n"), (None, "wide TEXT"), (5, "never-seen-anywhere zzzz"), (6, "日本 É é"), (7, "b b b c"), (7, "A"), (8, "x1y2 w0x0 one")]


@pytest.mark.parametrize("shard,chars", [(2_000_000, 8_000_000), (7, 8_000_000), (40, 20)])
def test_search_on_odd_rows(spark, make_docs, monkeypatch, shard, chars):
    monkeypatch.setattr(lexical, "SHARD", shard)
    docs = ODD + [(i, f"{'b ' * (i % 3)}common c{'' if i % 2 else ' rare'}") for i in range(100, 140)] + [(100, "other b text"), (None, "b c"), (None, "b c"), (99, "b c"), (99, "b c")]
    items = spark.createDataFrame([(*x, 1) for x in ITEMS + ITEMS[:1]], "item_id int, text string, doc_id int")
    with Scratch(spark, "t") as scratch:
        got = lexical.ranked(make_docs(docs), items, scratch, block_chars=chars).collect()
        assert by_text((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == by_text(plain.lexical(docs, ITEMS))
        assert lexical.ranked(make_docs([]), items, scratch).collect() == [] == lexical.ranked(make_docs(docs), items.limit(0), scratch).collect()


def test_best_positions_find_all_and_stop_early(monkeypatch):
    monkeypatch.setattr(lexical, "STEP", 4)
    rnd = np.random.default_rng(6)
    for high in (3, 10_000):     # many ties, few ties
        held = rnd.random((400, 12)) < 0.4
        impact = rnd.integers(0, high, (400, 12))
        doc, term = np.nonzero(held)
        lists = lexical.Lists(np.searchsorted(doc, np.arange(401)), term, impact[doc, term], 12)
        for _ in range(30):
            wanted = np.sort(rnd.choice(12, rnd.integers(1, 6), replace=False))
            times = rnd.integers(1, 4, len(wanted))
            score = (np.where(held, impact, 0)[:, wanted] * times).sum(axis=1)
            best = np.lexsort((np.arange(400), -score))[:5]
            docs, scores = lists.top(wanted, times, 5)
            order = np.lexsort((docs, -scores))[:5]
            assert docs[order].tolist() == [d for d in best.tolist() if score[d] > 0] and scores[order].tolist() == [s for s in score[best].tolist() if s > 0]
    read = []
    one = lexical.Lists(np.arange(1001), np.zeros(1000, np.int64), np.arange(1000), 1)
    monkeypatch.setattr(lexical.np, "unique", lambda x, f=np.unique: read.append(len(x)) or f(x))
    assert sorted(one.top(np.array([0]), np.array([1]), 3)[1].tolist()) == [997, 998, 999] and sum(read) < 20
