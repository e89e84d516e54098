"""The registered full-depth tree queries against the brute-force rules."""

import pytest

from gainkit.operators.sampling import hash_split
from gainkit.plans.tree_queries import BIN, TREE_QUERIES
from gainkit.plans.views import VIEWS, load_view
from tests import bruteforce as bf
from tests.conftest import SF0001


def sides(spark, name, key, seed=100):
    """Train rows, held-out rows and the whole tree of the train rows."""
    train, test = ([r.asDict() for r in x.collect()] for x in hash_split(load_view(spark, SF0001, name), key, (4, 1), seed))
    return train, test, bf.fit(train, [(s.name, s.kind) for s in VIEWS[name].spec], classes=BIN)[0]


def test_holdout_accuracy_docs_full(spark):
    _, test, tree = sides(spark, "v_docs", "doc_id")
    got = TREE_QUERIES["g4_holdout_accuracy_docs_full"][0](spark, SF0001).first()
    assert got["n_rows"] == len(test) and got["accuracy"] == pytest.approx(bf.accuracy(tree, test))


def test_fit_prune_orders_full(spark):
    _, test, tree = sides(spark, "v_orders", "o_orderkey")
    bf.prune(tree, test)
    assert bf.canon_spark(TREE_QUERIES["g5_fit_prune_orders_full"][0](spark, SF0001).collect()) == bf.canon(tree)


def test_repeated_holdout_docs_full(spark):
    got = {r["seed"]: r for r in TREE_QUERIES["g7_repeated_holdout_docs_full"][0](spark, SF0001).collect()}
    assert sorted(got) == [100, 200, 300, 400, 500]
    for seed, r in got.items():
        train, test, tree = sides(spark, "v_docs", "doc_id", seed)
        bf.prune(tree, test)
        assert (r["n_train"], r["n_test"]) == (len(train), len(test))
        assert r["accuracy"] == pytest.approx(bf.accuracy(tree, test))
