"""Operators 1, 2, 5, 7 and the component helper against plain statements."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from gainkit.llm import bytesops, embed, minhash, queries, suffix, warc
from gainkit.llm.components import components
from gainkit.session import Scratch
from tests.conftest import SF0001, SF001
from tests.llm import plain
from tests.llm.conftest import ODD


def texts(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def check_near(rows, docs, k, num, den):
    want = plain.near_documents(docs, k, num, den)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert len(rows) == len(want)
    assert {i for i in want if want[i] != got[i]} == set()


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_near_documents(spark, sf):
    rows = queries.op1_minhash_neardup(spark, sf).collect()
    check_near(rows, texts(spark, sf), 3, 85, 100)
    assert any(not r.kept for r in rows)


def variants(n, changes, words=160, seed=5):
    """One text and n variants of it, each with some words changed."""
    rnd = random.Random(seed)
    base = [f"word{rnd.randrange(4000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randrange(changes + 1)):
            w[rnd.randrange(words)] = f"other{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_near_documents_links_that_no_hub_has(spark, make_docs):
    docs = [(i, t) for i, t in enumerate(variants(90, 7) + variants(40, 4, seed=9) + variants(3, 0, words=2))]
    random.Random(1).shuffle(docs)
    docs = [(n, t) for n, (_, t) in enumerate(docs)]
    with Scratch(spark, "t") as scratch:
        check_near(minhash.near_duplicates(make_docs(docs), scratch, k=3, threshold=Fraction(85, 100)).collect(), docs, 3, 85, 100)
        check_near(minhash.near_duplicates(make_docs(docs), scratch).collect(), docs, 5, 4, 5)


def test_members_meet_once_and_the_largest_component_never_itself(spark):
    rows = [(1, n, 7 if n < 60 else 100 + n // 2) for n in range(75)] + [(2, n, n % 2) for n in range(6)] + [(3, n, n) for n in range(30)] + [(4, n, 5) for n in range(30)]
    dealt = minhash.dealt(spark.createDataFrame(rows, "key long, id long, comp long"), 8).collect()
    groups = {}
    for r in dealt:
        groups.setdefault((r.key, r.i, r.j), []).append(r)
    met = {}
    for (key, i, j), members in groups.items():
        for x in members:
            for y in members:
                if x.id < y.id and x.comp != y.comp and (i == j or x.own != y.own):
                    met[key, x.id, y.id] = met.get((key, x.id, y.id), 0) + 1
    assert met == {(k, x, y): 1 for k, x, c in rows for h, y, d in rows if k == h and x < y and c != d}
    assert sum(r.key == 1 and r.comp == 7 for r in dealt) <= 60 * 2 and not any(r.key == 4 for r in dealt)


def test_links_inside_buckets_do_not_depend_on_the_block(spark, make_docs, monkeypatch):
    docs = list(enumerate(variants(70, 9, seed=3)))
    whole = minhash.linked_inside
    monkeypatch.setattr(minhash, "linked_inside", lambda *a: whole(*a, block=5))
    with Scratch(spark, "t") as scratch:
        check_near(minhash.near_duplicates(make_docs(docs), scratch, k=3, threshold=Fraction(85, 100)).collect(), docs, 3, 85, 100)


def test_near_documents_on_odd_rows(spark, make_docs):
    with Scratch(spark, "t") as scratch:
        check_near(minhash.near_duplicates(make_docs(ODD), scratch, k=3, threshold=Fraction(85, 100)).collect(), ODD, 3, 85, 100)
        d = make_docs(ODD + [(4, "one"), (None, "a b c d e f g h i j k l m n o p q r s t u v w."), (None, None)])
        rows = minhash.near_duplicates(d, scratch).collect()
        assert len(rows) == len(ODD) + 3
        nulls = {r.n_shingles: r for r in rows if r.doc_id is None}
        assert nulls[19].component_id == 7 and not nulls[19].kept and nulls[0].component_id is None and nulls[0].kept
        assert [r.component_id for r in rows if r.doc_id in (4, 5)] == [4, 4, 4]
        left = minhash.drop_duplicates(d, scratch)
        assert left.columns == d.columns
        ids = [r.doc_id for r in left.collect()]
        assert ids.count(4) == 1 and 5 not in ids and 8 not in ids and ids.count(None) == 2
        assert minhash.near_duplicates(d.limit(0), scratch).count() == 0 and minhash.drop_duplicates(d.limit(0), scratch).count() == 0


def near_rows(docs, k, num, den):
    """The rule for rows whose ids repeat: sorted (id, n, component), null ids as the largest."""
    rows = [(2**63 - 1 if i is None else i, t) for i, t in docs]
    by_place = plain.near_documents(list(enumerate(t for _, t in rows)), k, num, den)
    low = {}
    for n, (i, _) in enumerate(rows):
        low[by_place[n][1]] = min(low.get(by_place[n][1], i), i)
    return sorted((i, by_place[n][0], low[by_place[n][1]]) for n, (i, _) in enumerate(rows)), [by_place[n][1] for n in range(len(rows))]


def test_near_documents_where_ids_repeat(spark, make_docs):
    a, b, c, d, e = (variants(3, 2, seed=s) for s in (21, 22, 23, 24, 25))
    docs = [(7, a[0]), (9, b[0]), (None, a[1]), (None, b[1]), (None, c[0]), (20, d[0]), (20, c[1]), (21, c[2]), (30, d[1]), (30, e[0]), (30, e[0]), (30, None), (31, e[1]), (20, "x y")]
    number = lambda i: 2**63 - 1 if i is None else i
    want, group = near_rows(docs, 5, 4, 5)
    for parts in (1, 3, 7):
        df = make_docs(docs).repartition(parts)
        with Scratch(spark, "t") as scratch:
            got = minhash.near_duplicates(df, scratch).collect()
            left = sorted((number(r.doc_id), r.text or "") for r in minhash.drop_duplicates(df, scratch).collect())
        assert sorted((number(r.doc_id), r.n_shingles, number(r.component_id)) for r in got) == want
        # the smallest (id, text) of a group is fixed here, as no group's smallest id has two texts
        first = {}
        for (i, t), g in zip(docs, group, strict=True):
            first[g] = min(first.get(g, (number(i), t or "")), (number(i), t or ""))
        once, stay = set(), []
        for (i, t), g in zip(docs, group, strict=True):
            row = (number(i), t or "")
            if i is None or not t or (first[g] == row and row not in once):
                stay.append(row)
                once.add(row)
        assert left == sorted(stay)


def test_words_that_cancel_a_polynomial(spark, make_docs):
    one = "".join("ab"[bin(n).count("1") % 2] for n in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    docs = [(1, f"p q {one}"), (2, f"p q {other}"), (3, f"{one} {other} z {one} {other} y")]
    with Scratch(spark, "t") as scratch:
        check_near(minhash.near_duplicates(make_docs(docs), scratch, k=3, threshold=Fraction(85, 100)).collect(), docs, 3, 85, 100)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 2**63, 3000, np.uint64), rng.integers(0, 2**63, 1000, np.uint64)
    both = np.concatenate((a, b))
    reg = lambda x: minhash.registers(np.zeros(len(x), np.int64), np.sort(x), 1)
    assert (minhash.merge(reg(a), reg(b)) == reg(both)).all()
    got = []
    for share in (0.5, 0.85, 0.95):
        est = []
        for s in range(30):
            x = rng.integers(0, 2**63, 2000, np.uint64)
            n = int(2000 * share)
            y, z = x[:n], np.concatenate((x[:n], rng.integers(0, 2**63, 0, np.uint64)))
            ra, rb = reg(x), reg(z)
            est.append(float(minhash.estimate((ra > rb).sum(axis=1), (ra < rb).sum(axis=1), np.array([len(x)]), np.array([len(y)]))[0]))
        got.append(abs(np.mean(est) - share))
    assert max(got) < 0.03
    rows, bands = minhash.bands(0.85)
    assert (1 - 0.85 ** rows) ** bands <= minhash.MISS


def test_components(spark):
    rnd = random.Random(2)
    for links in ([], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(49, 50)],
                  [(rnd.randrange(80), rnd.randrange(80)) for _ in range(60)]):
        with Scratch(spark, "t") as scratch:
            got = {r.v: r.component for r in components(spark.createDataFrame(links, "u long, v long"), scratch).collect()}
        ids = {x for a, b in links if a != b for x in (a, b)}
        assert got == plain.roots(ids, [x for x in links if x[0] != x[1]])


def check_vectors(rows, source):
    want = plain.near_vectors(source, embed.THRESHOLD)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in rows), key=str)
    true = sum(w[1] for w in want)
    found = sum(g[1] for g in got)
    assert len(got) == len(want) and found <= true
    return embed.recall(found, true), got == sorted(want, key=str)


def test_near_vectors(spark):
    for sf in (SF0001, SF001):
        source = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
        recall, same = check_vectors(queries.op5_pivot_neardup(spark, sf).collect(), source)
        assert recall >= 0.9 and (same or recall < 1)


def test_near_vectors_recall_at_the_threshold(spark):
    """Pairs just above the threshold, in 64 dimensions, among many others."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = rng.normal(size=(400, 64))
    near -= (near * x[:400]).sum(axis=1, keepdims=True) * x[:400]
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    y = 0.9805 * x[:400] + np.sqrt(1 - 0.9805**2) * near
    source = [(i, v.tolist(), i % 400 % 2 if i < 400 or i >= 1500 else 0) for i, v in enumerate(np.concatenate((x, y)))]
    df = spark.createDataFrame(source, "vec_id long, embedding array<double>, label int")
    with Scratch(spark, "t") as scratch:
        recall, _ = check_vectors(embed.near_duplicates(df, scratch).collect(), source)
    assert recall >= 0.9


def test_near_vectors_of_a_large_group(spark):
    """A third of the vectors is one group of near copies."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(2400, 64))
    x[:800] = rng.normal(size=64) + rng.normal(size=(800, 64)) * 0.07
    source = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(source, "vec_id long, embedding array<double>, label int")
    with Scratch(spark, "t") as scratch:
        recall, _ = check_vectors(embed.near_duplicates(df, scratch).collect(), source)
        blocks, _ = check_vectors(embed.near_duplicates(df, scratch, block=100).collect(), source)
    assert recall >= 0.9 and blocks == recall


def test_near_vectors_on_odd_rows(spark):
    v, w = [1.0, 0.0, 0.0], [0.999, 0.01, 0.0]
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (3, w, 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [0.0, 0.0, 0.0], 0), (8, [None, 1.0, 0.0], 0), (9, [float("nan"), 1.0, 0.0], 0),
            (10, [float("inf"), 1.0, 0.0], 0), (11, [], 0), (12, [1.0, 0.0], 0), (13, [1.0, 0.001], 0), (14, [1e30, 0.0, 0.0], 0), (15, [-1.0, 0.0, 0.0], 0)]
    schema = "vec_id long, embedding array<float>, label int, id string, v int, n int"
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], schema)
    with Scratch(spark, "t") as scratch:
        assert check_vectors(embed.near_duplicates(df, scratch).collect(), rows) == (1.0, True)
        assert check_vectors(embed.near_duplicates(df, scratch, block=2).collect(), rows) == (1.0, True)
        assert embed.near_duplicates(df.limit(0), scratch).count() == 0
        null = embed.near_duplicates(spark.createDataFrame([(None, v, 0, "", 1, 1), (3, v, 0, "", 1, 1)], schema), scratch).collect()
        assert sorted((r.vec_id is None, r.n_links, r.component_id, r.kept) for r in null) == [(False, 1, 3, True), (True, 1, 3, False)]


def test_hot_list_is_cut_into_blocks(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=24)
    source = [(i, (base + rng.normal(size=24) * 0.08).tolist(), 1) for i in range(120)]
    df = spark.createDataFrame(source, "vec_id long, embedding array<double>, label int")
    with Scratch(spark, "t") as scratch:
        whole = sorted(embed.near_duplicates(df, scratch, n_pivots=8).collect())
        assert whole == sorted(embed.near_duplicates(df, scratch, n_pivots=8, block=10).collect())
        recall, _ = check_vectors(whole, source)
    assert recall >= 0.9


def check_removed(rows, docs):
    want = plain.removed(docs)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    assert len(rows) == len(docs)
    assert {i for i in want if want[i] != got[i]} == set()


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_repeated_bytes(spark, sf):
    rows = queries.op7_suffix_dedup(spark, sf).collect()
    check_removed(rows, texts(spark, sf))
    assert any(0 < r.n_removed < r.n_bytes for r in rows)


def test_repeated_bytes_on_odd_rows(spark, make_docs):
    rnd = random.Random(7)
    abc = lambda n: "".join(rnd.choice("ab") for _ in range(n))
    passage, run = abc(70), "ab" * 200
    docs = [x for x in ODD if x[0] not in (9, 10)] + [
        (20, "q" * 49), (21, "q" * 49 + "z"), (22, "q" * 50), (23, "z" + "q" * 50), (24, passage), (25, "x" + passage + "y" + passage[:50]), (26, passage[1:] + passage),
        (27, run), (28, "c" + run + "d" + run[1:]), (29, run[:60]), (30, "é" * 40 + passage[:30]), (31, "é" * 40 + passage[:29]), (32, abc(3000)), (33, abc(3000)), (34, passage)]
    docs += [(40 + i, abc(30) + passage[i:] + abc(30) + passage[: 50 + i]) for i in range(20)]
    with Scratch(spark, "t") as scratch:
        check_removed(suffix.kept_digests(make_docs(docs), scratch).collect(), docs)
        twice = suffix.kept_digests(make_docs([(1, passage), (1, passage), (None, passage), (2, None)]), scratch).collect()
        assert sorted((r.doc_id or 99, r.n_removed) for r in twice) == [(1, 0), (1, 0), (2, 0), (99, 70)]
        assert suffix.kept_digests(make_docs([]), scratch).count() == 0


def removed_rows(docs, length=50):
    """The rule for rows whose ids repeat: [(id, n_bytes, n_removed, kept_sha256)], null ids last."""
    data = sorted((2**63 - 1 if i is None else i, t.encode()) for i, t in docs)
    first, out = {}, []
    for i, b in data:
        for p in range(len(b) - length + 1):
            first.setdefault(b[p:p + length], i)
    for i, b in data:
        gone = {q for p in range(len(b) - length + 1) if first[b[p:p + length]] < i for q in range(p, p + length)}
        out.append((i, len(b), len(gone), hashlib.sha256(bytes(c for q, c in enumerate(b) if q not in gone)).hexdigest()))
    return sorted(out)


def rows_with_repeated_ids():
    rnd = random.Random(8)
    abc = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    shared, copied, own = abc(90), abc(120), abc(80)
    docs = [(1, copied), (None, copied), (None, abc(200)), (None, own), (None, "z" * 60), (2, abc(40) + shared + abc(40)), (None, abc(10) + shared), (None, abc(170) + shared + abc(9)),
            (7, copied), (7, abc(300)), (7, shared), (7, shared), (7, abc(70) + own[:60]), (None, own + abc(200) + own), (None, "short"), (3, abc(60) + "zz"), (None, abc(60))]
    docs += [(i, abc(20) + shared + copied[:70] + abc(15)) for i in (None, None, 7, 7, 9, 9)]
    # equal contexts on both sides of the anchors, under one id and before any smaller id's text in the same block
    docs += [(i, abc(30) + docs[5][1] + abc(30) + docs[5][1] + abc(5)) for i in (None, None, 7)]
    return docs


def test_repeated_bytes_where_ids_repeat(spark, make_docs):
    docs = rows_with_repeated_ids()
    with Scratch(spark, "t") as scratch:
        got = suffix.kept_digests(make_docs(docs).repartition(2), scratch).collect()
        assert sorted((2**63 - 1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in got) == removed_rows(docs)
        one = suffix.kept_digests(make_docs(docs).coalesce(1), scratch).collect()
        assert sorted(one, key=str) == sorted(got, key=str)


@pytest.mark.parametrize("slice_bytes", [1, 300, 900])
def test_repeated_bytes_where_ids_repeat_in_pieces_of_a_block(monkeypatch, slice_bytes):
    monkeypatch.setattr(bytesops, "SLICE_BYTES", slice_bytes)
    docs = [(2**63 - 1 if i is None else i, t) for i, t in rows_with_repeated_ids()]
    docs += [(11, docs[3][1] + docs[7][1] * 2), (11, docs[3][1] + docs[7][1] * 2), (10, docs[7][1])]
    n, key = len(docs), (pa.scalar(0),)
    texts = pa.table({"block": pa.array([0] * n), "doc": pa.array([i for i, _ in docs]), "text": pa.array([t for _, t in docs]), "row": pa.array(range(n), pa.int32())})
    out = suffix._suffixes(np.zeros(0, np.uint64))(key, texts, pa.table({"block": pa.array([], pa.int64()), "blob": pa.array([], pa.binary())}))
    found = pa.concat_tables([suffix._in_range(out.slice(k, 1)) for k in range(out.num_rows)])
    got = suffix._united(key, texts, found).to_pylist()
    assert sorted((r["doc"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in got) == removed_rows(docs)


def test_repeated_bytes_of_a_hot_passage(spark, make_docs, monkeypatch):
    """A third of the documents hold one passage between different neighbours, others are exact copies in many blocks."""
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 4_000)
    rnd = random.Random(31)
    abc = lambda n: "".join(rnd.choice("abcdefghij ") for _ in range(n))
    passage, copied = abc(300), abc(400)
    docs = [(i, abc(rnd.randrange(80)) + passage + abc(rnd.randrange(80)) if i % 3 == 0 else copied if i % 3 == 1 else abc(rnd.randrange(200))) for i in range(180)]
    rnd.shuffle(docs)
    with Scratch(spark, "t") as scratch:
        check_removed(suffix.kept_digests(make_docs(docs).repartition(5), scratch).collect(), docs)


def test_repeated_bytes_with_small_blocks(spark, monkeypatch):
    from gainkit.llm import suffix as s
    monkeypatch.setattr(s, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(bytesops, "SLICE_BYTES", 5_000)
    check_removed(queries.op7_suffix_dedup(spark, SF0001).collect(), texts(spark, SF0001))


def test_multikey_quicksort():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 3000):
        k = rng.integers(0, 4, (n, 5)).astype(np.uint64)
        assert [tuple(x) for x in k[suffix.multikey_quicksort(k, small=8)]] == sorted(map(tuple, k))


PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("k", T.StringType()), T.StructField("leaf", T.LongType())])


def audit(spark, a, b, **kw):
    make = lambda rows: spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES)
    with Scratch(spark, "t") as scratch:
        return sorted(((r.k, r.status) for r in warc.audit(make(a), make(b), scratch, **kw).collect()), key=str)


def test_audit_finds_every_difference(spark):
    a = [(i, f"u{i}", f"<p>{i}</p>") for i in range(-3, 200)]
    b = [(i, u, h + "!" if i in (0, 77) else h) for i, u, h in a if i not in (5, 199)] + [(500, "u", "new")]
    want = {i: "ok" for i, _, _ in a} | {0: "corrupt", 77: "corrupt", 5: "missing", 199: "missing", 500: "extra"}
    for fanout in (2, 64):
        assert dict(audit(spark, a, b, fanout=fanout)) == want
    assert dict(audit(spark, a, a)) == {i: "ok" for i, _, _ in a}


def test_audit_on_odd_rows(spark):
    a = [(None, None, None), (1, None, "x"), (1, "u", "y"), (1, "u", "y"), (2, "", ""), (2**62, "u", "é" * 10000)]
    assert audit(spark, a, a) == sorted([(r[0], "ok") for r in a], key=str)
    assert audit(spark, a, a[:-1]) == sorted([(r[0], "ok") for r in a[:-1]] + [(2**62, "missing")], key=str)
    assert audit(spark, [], []) == [] and audit(spark, a, []) == sorted([(r[0], "missing") for r in a], key=str)
    assert audit(spark, [], a[1:2]) == [(1, "extra")]


def test_audit_offsets(spark):
    rows = queries.op2_merkle_fixity(spark, SF001).orderBy("page_id").collect()
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_bytes
    assert {r.status for r in rows} == {"ok", "corrupt", "missing"}
