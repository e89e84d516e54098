"""A fitted tree scores a file stream exactly like the batch table."""

from gainkit import fit, predict
from gainkit.plans.views import VIEWS, load_view
from gainkit.streaming import running_accuracy, score_stream
from tests.conftest import SF0001


def test_stream_scoring_matches_batch(spark, tmp_path):
    v = load_view(spark, SF0001, "v_events")
    model = fit(v, "class", list(VIEWS["v_events"].spec), classes=["0", "1"], max_depth=1)
    src = str(tmp_path / "in")
    v.write.parquet(src)
    stream = spark.readStream.schema(v.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (score_stream(model, stream, keep=["event_id", "class"]).writeStream.format("memory")
         .queryName("scored_events").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck1")).start())
    q.processAllAvailable()
    q.stop()
    got = {r["event_id"]: r["prediction"] for r in spark.sql("SELECT * FROM scored_events").collect()}
    want = {r["event_id"]: r["prediction"] for r in predict(model, v).collect()}
    assert got == want and len(got) == v.count()

    q2 = (running_accuracy(model, stream).writeStream.format("memory").queryName("acc_events")
          .outputMode("complete").option("checkpointLocation", str(tmp_path / "ck2")).start())
    q2.processAllAvailable()
    q2.stop()
    row = spark.sql("SELECT * FROM acc_events").first()
    assert row["n_rows"] == v.count()
    assert row["n_correct"] == sum(1 for r in predict(model, v).collect() if r["prediction"] == r["class"])
