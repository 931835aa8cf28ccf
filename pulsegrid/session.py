"""Session settings and the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT = "spark.checkpoint.dir"
_OWN: list[str] = []  # the folder that local mode falls back to
_WORK: list[tuple[SparkSession, str]] = []  # folders of intermediate results, dropped when the driver's process ends

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(name: str = "pulsegrid", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings; ``extra`` uses ``__`` for dots (``spark__ui__enabled="false"``)."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in extra.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Give a foreign session the runtime settings on which results depend."""
    for key in ("spark.sql.session.timeZone", "spark.sql.variant.allowDuplicateKeys"):
        spark.conf.set(key, SETTINGS[key])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    A temporary folder takes its place only in local mode, where driver and executors are one machine; on a cluster
    without the setting this raises, since a machine-local folder would be lost with its machine.
    """
    path = spark.sparkContext.getConf().get(CHECKPOINT, None) or spark.conf.get(CHECKPOINT, None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError(f"set {CHECKPOINT} to a folder that all executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="pulsegrid-"))
            atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
        path = _OWN[0]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there: computed once, and safe if executors are lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """Like ``cut``, as a compressed table: for results that are as large as the input, or read by columns."""
    path = work_path(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; what is written there lasts as long as the driver's process."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    if not _WORK:
        atexit.register(_drop_work)
    _WORK.append((spark, path))
    return path


def _drop_work() -> None:
    for spark, path in _WORK:
        if spark.sparkContext._jsc is not None:
            drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
