"""Session defaults and the shared scratch area used by multi-step jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that results or file statistics depend on; set on any session in use.
RUNTIME = {
    # calendar parts (month, hour, day) must not follow the host's zone
    "spark.sql.session.timeZone": "UTC",
    # the legacy 96-bit format carries no statistics, so scans could not skip by time
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # batches for Python workers are bounded by their size, not by rows of unknown length
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    # keyed stream state lives on disk, so it may outgrow executor memory
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

DEFAULTS = RUNTIME | {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

_local_root: str | None = None


def build_session(app: str = "quakeloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings this library relies on to a session made elsewhere."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a local folder only in local mode."""
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="quakeloom-")
    return _local_root


def _file(spark: SparkSession, path: str):
    """Hadoop's path and file system: Spark's own API can neither list nor delete."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _file(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    target, fs = _file(spark, path)
    fs.delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder. Whoever asked for it may :func:`delete`
    it when done; what is left goes when the driver JVM exits."""
    path = f"{shared_root(spark)}/quakeloom/{label}-{uuid.uuid4().hex}"
    target, fs = _file(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    What is written is scanned once, a lost executor costs nothing already
    written, and the planner sees the table's real size when it picks a join.
    """
    path = f"{scratch_path(df.sparkSession, label)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
