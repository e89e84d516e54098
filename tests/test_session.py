"""Lineage cuts go to the session's checkpoint folder and never replace it."""

from urllib.parse import urlparse

from gainkit.session import cut_lineage, ensure_checkpoint_dir


def test_written_tables_live_under_checkpoint_dir(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert before
    assert ensure_checkpoint_dir(spark) == before      # an existing setting is kept
    df = spark.range(10).withColumnRenamed("id", "x")
    out = cut_lineage(df)
    files = out.inputFiles()
    root = urlparse(before).path.rstrip("/")
    assert files and all(urlparse(f).path.startswith(root + "/") for f in files)
    assert sorted(r["x"] for r in out.collect()) == list(range(10))


def test_fit_and_prune_leave_only_their_trees(spark):
    import os

    from gainkit import FeatureSpec, fit, prune
    root = urlparse(spark.sparkContext.getCheckpointDir()).path
    before = set(os.listdir(root))
    df = spark.createDataFrame([(str(i % 3 > 0), float(i % 3), float(i)) for i in range(12)], "class string, a double, b double")
    spec = [FeatureSpec("a", "continuous"), FeatureSpec("b", "continuous")]
    model = fit(df, "class", spec, max_depth=1)
    pruned = prune(model, df)
    assert model.tree.count() == 3 and pruned.tree.count() <= 3
    left = set(os.listdir(root)) - before
    assert len(left) == 2 and all(x.startswith("gainkit-tree-") for x in left), left
    try:
        fit(df.withColumn("a", df.a * float("nan")).selectExpr("class", "nullif(b, 3) AS a", "b"), "class", spec)
    except ValueError:
        pass
    assert set(os.listdir(root)) - before == left
