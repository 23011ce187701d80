"""Session settings the operators rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    # JSON objects that name a member twice keep the last one instead of failing the job.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options that the operators need; safe to repeat."""
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; where that is unset a local one, in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not named and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="quernel-checkpoint-"))
    return named or context.getCheckpointDir()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder, removed when the application ends."""
    name = f"{checkpoint_dir(spark).rstrip('/')}/quernel/{purpose}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return name


def cut(df: DataFrame) -> DataFrame:
    """Materialize df in the shared folder, so that later stages survive a lost executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{directory}/{name}.parquet")
