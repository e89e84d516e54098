"""The whole pipeline against a brute-force run of its stages, and operator 10 on held-out labels."""

import public_tokenizers as P
from pyspark.sql import functions as F

import corpus_pipeline
from gainkit.llm import quality, toxicity
from tests.conftest import SF0001
from tests.llm import plain
from tests.llm.conftest import DOCS, ODD


def test_pipeline_is_its_stages_by_brute_force(spark, tmp_path):
    import tiktoken
    rank_file = P.path("byte_bpe_50k.tiktoken")
    tik = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=plain.merges(rank_file), special_tokens={})
    given = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    odd = [(10 ** 6 + i, t, None) for i, t in ODD]
    body = "\n".join(f"Sentence {i} of a clean text says {i * 31 % 17} things about ordinary matters of the day." for i in range(9))
    own = [(2 * 10 ** 6, body, "x"), (2 * 10 ** 6 + 1, body + " End.", "x"),
           (2 * 10 ** 6 + 2, "Home | Shop | Help | More\n" + body.replace("ordinary", "private") + "\nSSN 123-45-6789 and DE89 3704 0044 0532 0130 00.", "y"),
           (2 * 10 ** 6 + 3, "sûr dû goût août " + body.replace("ordinary", "french"), "y")]
    docs = given + odd + own
    rows = [(i, t, "en", s, None if t is None else len(t), "x", 1, "other", 2, 3, "ids") for i, t, s in docs]
    spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = plain.pipeline(docs, tik.encode_ordinary)
    key = lambda r: (r[0], r[4])
    assert sorted(((r.doc_id, r.text, r.source, r.n_chars, tuple(r.token_ids)) for r in got), key=key) == sorted(want, key=key)
    assert all((r.key, r._text, r._doc, r._size, r.id) == (1, "other", 2, 3, "x") for r in got)


def test_pipeline_on_an_empty_table(spark, make_docs, tmp_path):
    make_docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_lines_with_accents_are_not_navigation(spark, make_docs):
    line = "Bien sûr, il a dû avoir du goût en août."
    assert quality.measure(make_docs([(1, line), (2, "Accueil » Boutique » Aide » Contact")])).select("doc_id", "n_bad_lines").orderBy("doc_id").collect() == [(1, 0), (2, 1)]


def categories():
    return {"junk": 1 - F.col("quality"), "toxic": F.col("toxic")}


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    chain = toxicity.fit(docs, labels.filter(~held), categories())
    assert [x.name for x in chain.links] == ["junk", "toxic"]
    rows = toxicity.score(docs, chain).join(labels.filter(held).filter("toxic is not null"), "doc_id").select("is_toxic", "toxic").collect()
    hit = [r.is_toxic for r in rows if r.toxic]
    false = [r.is_toxic for r in rows if not r.toxic]
    assert hit and sum(hit) >= 0.85 * len(hit) and sum(false) <= 0.01 * len(false)


def test_toxicity_on_odd_rows(spark, make_docs):
    labels = spark.createDataFrame([(5, 1, 1), (7, 1, 0), (8, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    d = make_docs(ODD + [(5, "another text")] * 50)
    chain = toxicity.fit(d, labels, categories())
    out = toxicity.score(d, chain).collect()
    assert len(out) == len(ODD) + 50 and all(0 <= r.p_junk <= 1 and 0 <= r.p_toxic <= 1 for r in out)
    again = toxicity.score(d, toxicity.fit(d.repartition(7), labels, categories())).collect()
    assert sorted(out) == sorted(again)
    assert toxicity.score(d.limit(0), chain).count() == 0
    none = toxicity.score(d, toxicity.fit(d, labels.limit(0), categories())).collect()
    assert {(r.p_junk, r.p_toxic) for r in none} == {(0.5, 0.5)}
