"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job is planned for. Sizes are left to the cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "assetloom", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with ``SESSION_CONF`` applied; ``conf`` adds or overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests) gets one of its own when it is unset.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="assetloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused between runs."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage and survives executor loss; later passes read only the columns
    they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and the constructor of its paths."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, if it is there."""
    fs, to_path = file_system(spark, path)
    fs.delete(to_path(path), True)
