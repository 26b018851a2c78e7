"""Session helpers: settings for local runs and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "tribuna", cores: str | None = None) -> SparkSession:
    """Session for tests and the bench.  A cluster brings its own."""
    n = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", n)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call-site capture costs several round trips per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master with the setting absent falls back to a temporary
    folder, one per application; a cluster without it is refused, as executors
    could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tribuna-")
    return _LOCAL_DIRS[app]


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so never cleared."""
    return f"{shared_dir(spark).rstrip('/')}/tribuna/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives executor loss."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


_SCHEMAS: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table.  Its schema is read from the files once per process."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


SMALL_SPLITS = 8


def spread(df: DataFrame) -> DataFrame:
    """Spreads a small input over the cores.

    Row-wise work on one small file would otherwise run in one task.  Only
    inputs of at most eight splits (a gigabyte at the default split size) are
    moved; anything larger passes through, so no shuffle is added where it
    would cost.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < min(cores, SMALL_SPLITS + 1) else df


def prepare(spark: SparkSession) -> None:
    """Runtime settings the plans count on.

    Times are UTC throughout.  A join side with one hot key is split even when
    that means a further shuffle for the operator above it.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # Streaming state: on disk instead of the heap, checkpointed by its changes.
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def coalesce_empty(col) -> F.Column:
    """Text with null as the empty string, the way state rows are compared."""
    return F.coalesce(col.cast("string"), F.lit(""))
