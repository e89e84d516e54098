"""Session helpers: local sessions for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "gainkit") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of
    the session. Only a local master may go without one (it then gets a fresh
    scratch folder); on a cluster a machine-local folder would lose rows, so a
    missing setting raises."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="gainkit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


class Scratch:
    """One folder of written intermediate tables under the shared checkpoint
    folder. ``cut`` writes a frame as Parquet and reads it back, so it is
    computed once and later plans survive the loss of any executor. ``drop``
    deletes a table that later plans no longer read, ``close`` the whole
    folder; used as a context manager the folder goes when the block fails."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/gainkit-{name}-{uuid.uuid4().hex}"
        self._n = 0
        self._at: dict[int, tuple[DataFrame, str]] = {}

    def cut(self, df: DataFrame) -> DataFrame:
        self._n += 1
        path = f"{self.path}/t{self._n:04d}"
        df.write.mode("error").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._at[id(out)] = (out, path)
        return out

    def bucketed(self, df: DataFrame, buckets: int, *keys: str):
        """Writes the frame bucketed by ``keys``, so that grouping and joining
        by them needs no shuffle of it. Returns (frame, function that drops it)."""
        name, path = f"gainkit_{uuid.uuid4().hex}", f"{self.path}/b{uuid.uuid4().hex}"
        df.write.bucketBy(buckets, *keys).option("path", path).saveAsTable(name)

        def drop():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            _delete(self.spark, path)

        return self.spark.table(name), drop

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            held = self._at.pop(id(df), None)
            if held:
                _delete(self.spark, held[1])

    def delete(self, path: str) -> None:
        """Deletes a path of this folder that is not held as a frame."""
        if not path.startswith(f"{self.path}/"):
            raise ValueError(f"{path} is not under {self.path}")
        _delete(self.spark, path)

    def close(self) -> None:
        _delete(self.spark, self.path)
        self._at.clear()

    def __enter__(self):
        return self

    def __exit__(self, kind, *_):
        if kind is not None:
            self.close()


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cut_lineage(df: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Write the frame under the shared checkpoint folder and read it back."""
    return (scratch or Scratch(df.sparkSession, "tables")).cut(df)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
