"""Operators 3, 4, 6, 8, 9 against plain statements, on the small tables and on odd rows."""

import hashlib
import itertools
import re

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from gainkit.llm import mixing, pii, quality, queries, spbpe, tokenfile
from gainkit.llm.bytesops import text_slices
from gainkit.session import Scratch
from tests.conftest import SF0001, SF001
from tests.llm import plain
from tests.llm.conftest import ODD

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def tik():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=plain.merges(RANKS), special_tokens={})


def test_bpe_ids_and_bytes(spark, docs, tik):
    got = {r.doc_id: r for r in queries.op6_byte_bpe(spark, SF0001).collect()}
    assert got.keys() == docs.keys()
    for i, t in docs.items():
        ids = tik.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_round_trip_on_odd_rows(spark, make_docs, tik):
    d = make_docs(ODD + ODD[-2:])
    out = spbpe.decode(spbpe.encode(d, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert len(out) == len(ODD) + 2
    for r in out:
        assert list(r.token_ids) == tik.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
        assert r.key == 1 and r._size == 3
    assert spbpe.encode(d.limit(0), RANKS, P.PATTERN).count() == 0 and spbpe.digests(d.limit(0), RANKS, P.PATTERN).count() == 0


def test_cut_before_space_never_changes_ids(spark, make_docs, tik):
    texts = ["a  b", "a \n b", "a\n\n  b", " lead", "trail ", "trail  ", "x　 y", "x 　y", "tab\t x", "a \x1c b", "a  b 's 're", "\n", "  ", "a \u0085b"]
    d = make_docs(list(enumerate(texts)))
    for r in spbpe.encode(d, RANKS, P.PATTERN).collect():
        assert list(r.token_ids) == tik.encode_ordinary(r.text), repr(r.text)


def test_serialised_model_merges_by_rank():
    c = spbpe.codec(RANKS, P.PATTERN)
    assert c.processor.get_piece_size() == 50257 and c.processor.id_to_piece(0) == "!" and c.processor.get_score(7) == -7.0
    assert sorted(c.chars) == sorted(set(c.chars)) and len(c.chars) == 256


def check_files(got, docs):
    start = 0
    for i in sorted(docs):
        ids = plain.library_ids(JSON, docs[i]) + [0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), plain.crc(ids)), i
        start += len(ids)


def test_token_files(spark, docs):
    check_files({r.doc_id: r for r in queries.op3_token_files(spark, SF0001).collect()}, docs)


def test_token_files_on_odd_rows(spark, make_docs):
    import numpy as np
    with Scratch(spark, "t") as scratch:
        places = tokenfile.write(make_docs(ODD), JSON, scratch, length=16)
        check_files({r.doc_id: r for r in tokenfile.read(places).collect()}, dict(ODD))
        for file, n in places.groupBy("file").agg(F.sum("n_tokens")).collect():
            f = tokenfile.TokenFile(file)
            ids, mask = zip(*(f.sequence(k) for k in range(-(-n // 16))), strict=True)
            assert all(len(x) == 16 for x in ids) and sum(int(np.sum(m)) for m in mask) == n
            assert f.ids[0].dtype == np.uint16 and not f.ids[0].flags.owndata
        assert tokenfile.read(tokenfile.write(make_docs([]), JSON, scratch)).count() == 0
        twice = tokenfile.read(tokenfile.write(make_docs([(5, "a b"), (5, "a b"), (None, "c")]), JSON, scratch)).orderBy("start").collect()
        assert [r.doc_id for r in twice] == [None, 5, 5] and twice[1].ids_crc32 == twice[2].ids_crc32


def test_token_files_with_special_tokens_in_texts(spark, make_docs):
    docs = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, "a  <|endoftext|>  b <|endoftext|><|endoftext|> c"), (4, " <|endoftext|>x <b> <|endof"),
            (5, "word " * 50 + "<|endoftext|>" + " word" * 50), (6, "\n <|endoftext|>\n")]
    assert plain.library_ids(JSON, docs[0][1]) == [64, 220, 50256, 275]
    with Scratch(spark, "t") as scratch:
        check_files({r.doc_id: r for r in tokenfile.read(tokenfile.write(make_docs(docs), JSON, scratch)).collect()}, dict(docs))


#: what stands around the places where texts are cut, in every order
PARTS = ["ab", "Z", "é", "日", "7", "९", "'", "'s", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\u0085", "\u3000", "\u2003", ".", ",", "<|endoftext|>", "<|", "endoftext", "|>"]


def ids_of(cache, texts, limit=None):
    import numpy as np
    import pyarrow as pa
    out = []
    for _, data, offsets in text_slices(pa.array(texts, pa.large_string()), limit):
        ids, n = cache.encode_slice(data, offsets)
        out += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    return out


def test_cuts_never_change_ids(tik):
    texts = ["".join(p) for p in itertools.product(PARTS, repeat=3)] + ["", "ab " * 200 + "ab", " " * 300, "<|endoftext|>" * 30]
    library, codec = tokenfile.LibraryEncoder(JSON), spbpe.Codec(RANKS, P.PATTERN)
    for limit, held in ((None, 10**6), (400, 50)):
        library.cache.limit = codec.cache.limit = held
        for text, ids, own in zip(texts, ids_of(library.cache, texts, limit), ids_of(codec.cache, texts, limit), strict=True):
            assert ids == library.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
            assert own == tik.encode_ordinary(text), repr(text)


def test_marks_that_do_not_fit_are_not_trusted():
    e = tokenfile.LibraryEncoder(JSON)
    texts = ["one two,\nthree", " four\nfive . six"]
    e.opens[:] = True
    assert ids_of(e.cache, texts) == [plain.library_ids(JSON, t) for t in texts]


def test_a_word_is_encoded_once_whatever_follows_it(monkeypatch):
    """The cost of op3 is that of its distinct chunks, not of all that they stand before."""
    words = [a + b + c for a in ("ka", "lo", "mi", "nu") for b in ("ra", "se", "ti") for c in ("p", "qua", "xel")]
    text = "a" + "".join(f" {w}{end}" for end in ("", ",", ".", ";\n", "!") for w in words)
    e, seen = tokenfile.LibraryEncoder(JSON), []
    encode = e.cache.encode
    monkeypatch.setattr(e.cache, "encode", lambda *a: (seen.append(len(a[-1])), encode(*a))[1])
    assert ids_of(e.cache, [text, text]) == 2 * [plain.library_ids(JSON, text)]
    assert sum(seen) < 2 * len(words)


def test_places_of_hashes():
    import numpy as np
    from gainkit.llm.chunkcache import Places
    rng, table, n = np.random.default_rng(3), Places(3), 0
    keys = np.unique(np.concatenate((rng.integers(0, 2**63, 5000).astype(np.uint64), np.arange(300, dtype=np.uint64) << np.uint64(32))))
    for part in np.array_split(rng.permutation(keys), 7):
        assert (table.get(part) == -1).all()
        table.put(part, np.arange(n, n + len(part)))
        assert (table.get(part) == np.arange(n, n + len(part))).all()
        n += len(part)
    assert sorted(table.get(keys).tolist()) == list(range(len(keys)))


def check_pii(rows, docs):
    for r in rows:
        counts, digest, joined = plain.pii_row(docs[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == counts and r.base_sha256 == digest, r
        if not r.n_iban and not r.n_ssn:
            assert r.spans == joined


def test_pii_spans(spark, docs):
    rows = queries.op4_pii(spark, SF0001).collect()
    assert len(rows) == len(docs) and any(r.spans for r in rows)
    check_pii(rows, docs)


PII = ["mail a@b.co, a.b+c@x-y.example.org!", "a@b.c_x@d.e and @x.y a@b a@.c", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.0004", "9" * 5000, "1." * 3000 + "1",
       "4111 1111 1111 1111 and 4111-1111-1111-1112", "+49 (0) 30 1234-567. +1 2", "a" * 20000 + "@" + "b." * 400 + "c", "é 😀 a@b.co 1.2.3.4 +123456789012",
       "IBAN DE89 3704 0044 0532 0130 00 ok, GB82 WEST 1234 5698 7654 32 DE00 3704 0044 0532 0130 00", "my SSN 123-45-6789; 123-45-6780 stands alone, far away" + " x" * 60 + " 123-45-6781",
       "+1 2@x.io 4111111111111111+4912345678901", "", None, "0000000000000001.1.1.1 a@b.co" + " c@d.eu" * 300]


def test_pii_on_odd_rows(spark, make_docs):
    pairs = list(enumerate(PII)) + [(100 + i, t) for i, t in ODD]
    d = make_docs(pairs + pairs[:3])
    rows = pii.detect(d).collect()
    assert len(rows) == len(pairs) + 3
    check_pii(rows, dict(pairs))
    by = {r.doc_id: r for r in rows}
    assert by[9].n_iban == 2 and by[10].n_ssn == 1 and "iban:5:" in by[9].spans
    out = {r.doc_id: r for r in pii.redact(make_docs(pairs)).collect()}
    for i, t in pairs:
        assert (out[i].text is None) == (t is None) and (t is None or out[i].n_chars == len(out[i].text))
        if t and not plain.base_spans(t) and i not in (9, 10):
            assert out[i].text == t
        assert not plain.base_spans(out[i].text or ""), i
    assert out[0].text == "mail [EMAIL], [EMAIL]!" and out[5].text.startswith("[CARD] and 4111-") and "SSN [SSN]" in out[10].text
    assert pii.detect(d.limit(0)).count() == 0 and pii.redact(d.limit(0)).count() == 0


def test_quality_base(spark, docs):
    got = queries.op8_quality_rules(spark, SF0001).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain.quality_base(docs[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_quality_on_odd_rows(spark, make_docs):
    d = make_docs(ODD + ODD[:2])
    got = quality.measure(d).collect()
    texts = dict(ODD)
    assert len(got) == len(ODD) + 2
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain.quality_base(texts[r.doc_id]), r
    kept = {r.doc_id for r in got if r.kept}
    out = quality.clean(d).collect()
    assert {r.doc_id for r in out} == kept and all(r.n_chars == len(r.text) and r._doc == 2 for r in out)
    assert quality.measure(d.limit(0)).count() == 0 and quality.clean(d.limit(0)).count() == 0


def cancelling():
    """Texts of words that cancel a polynomial hash modulo 2^64: Thue-Morse words and their complements."""
    one = "".join("ab"[bin(n).count("1") % 2] for n in range(2048))
    other = one.translate(str.maketrans("ab", "ba"))
    return [(1, f"x {one} {other} y"), (2, f"{one}\n{other}\n{one}\n z"), (3, other), (4, one[:1024]), (5, f"{other[:1024]} {one[:1024]}"), (6, f"q {one[:256]} {other[:256]}")]


def test_words_that_cancel_a_polynomial(spark, make_docs, tik):
    pairs = cancelling()
    texts, d = dict(pairs), make_docs(pairs).coalesce(1)
    for r in quality.measure(d).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain.quality_base(texts[r.doc_id])
    for r in spbpe.digests(d, RANKS, P.PATTERN).collect():
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, tik.encode_ordinary(texts[r.doc_id]))).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_quality_lines_go(spark, make_docs):
    body = "\n".join(f"This is sentence number {i} of a text that nobody would reject, {i * 31 % 17} times over." for i in range(6))
    nav = "Home | About | Contact | Shop"
    rows = [(1, body), (2, f"{nav}\n{body}\nAll rights reserved."), (3, "\n".join([nav] * 3 + [f"a{i} | b{i} | c{i} | d{i}" for i in range(30)] + ["One sentence stays here."])),
            (4, " ".join(f"word{i}***" for i in range(60)))]
    out = {r.doc_id: r.text for r in quality.clean(make_docs(rows)).collect()}
    assert out == {1: body, 2: body + "\n"}


def test_quality_agrees_with_labels(spark):
    lab = spark.read.parquet(f"{SF001}/labels.parquet").filter("quality is not null")
    q = quality.measure(spark.read.parquet(f"{SF001}/documents.parquet"))
    rows = q.join(lab, "doc_id").filter("n_words >= 20").select("kept", "quality").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.1 * len(junk)


def check_mix(rows, sizes_of, source_of):
    total = {}
    for i, s in source_of.items():
        total[s] = total.get(s, 0) + sizes_of[i]
    aim = plain.targets(total)
    taken = {}
    for r in rows:
        s = source_of[r.doc_id]
        assert r.size == sizes_of[r.doc_id] and r.source_size == total[s] and r.target == pytest.approx(aim[s]) and r.taken in (0, r.size, 2 * r.size)
        taken[s] = taken.get(s, 0) + r.taken
    return aim, taken


def test_mix_meets_targets(spark, docs):
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "source").collect()}
    rows = queries.op9_source_mix(spark, SF0001).collect()
    sizes = {i: len(plain.WORD.findall(t or "")) for i, t in docs.items()}
    aim, taken = check_mix(rows, sizes, source)
    biggest = {}
    for i, s in source.items():
        biggest[s] = max(biggest.get(s, 0), sizes[i])
    assert all(abs(taken[s] - aim[s]) <= 1.5 * biggest[s] for s in aim)
    assert sorted(rows) == sorted(queries.op9_source_mix(spark, SF0001).collect())


def test_mix_buckets_do_not_change_the_order(spark, monkeypatch):
    whole = sorted(queries.op9_source_mix(spark, SF0001).collect())
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 2)
    assert sorted(queries.op9_source_mix(spark, SF0001).collect()) == whole


def test_mix_on_odd_rows(spark, make_docs):
    a, b, c = make_docs(ODD, source="a"), make_docs([(i + 100, t) for i, t in ODD] * 2, source=None), make_docs([(900, None), (901, "")], source="")
    d = a.unionByName(b).unionByName(c)
    m = mixing.mix(d).collect()
    assert len(m) == d.count() and all(0 <= r._copies <= 2 for r in m)
    words = {None: 0, "a": 0, "": 0}
    for r in m:
        words[r._doc.source] += r._size
    aim = plain.targets(words)
    assert all(r._target == pytest.approx(aim[r._doc.source]) and r._source_size == words[r._doc.source] for r in m)
    out = mixing.sample(d)
    assert out.columns == d.columns and out.count() == sum(r._copies for r in m)
    assert mixing.mix(d.limit(0)).count() == 0 and mixing.sample(d.limit(0)).count() == 0


def test_mix_agrees_on_rows_without_or_with_repeated_ids(spark, make_docs):
    docs = [(None if i % 2 else i % 10, f"{'word ' * (5 + i % 3)}of row {i}") for i in range(80)] + [(None, "alike " * 6)] * 4
    runs = [sorted((r._doc.doc_id is None, r._doc.doc_id or 0, r._doc.text, r._copies) for r in mixing.mix(make_docs(docs).repartition(n)).collect()) for n in (3, 5, 7)]
    assert len(runs[0]) == 84 and runs[0] == runs[1] == runs[2]
    assert {r[3] for r in runs[0]} == {1, 2}


def test_native_operators_run_no_python(spark):
    for q in (queries.op4_pii, queries.op9_source_mix):
        plan = q(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)
