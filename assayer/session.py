"""Session settings and the shared folder that jobs may write intermediate data to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.scheduler.mode": "FAIR",
}


def build_session(app_name: str = "assayer", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators are tuned for; ``settings`` win over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a temporary folder: there all tasks run in one process.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="assayer-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder so later jobs neither recompute it nor lose it with an executor."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of Spark's own storage layer."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    system, where = _file_system(spark, path)
    if not system.exists(where):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(where) if entry.isDirectory())


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all that is in it; whether there was one."""
    system, where = _file_system(spark, path)
    return bool(system.exists(where) and system.delete(where, True))


def claim_path(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it is there: true for one caller only, whoever asks at the same time."""
    system, where = _file_system(spark, path)
    system.mkdirs(where.getParent())
    return bool(system.createNewFile(where))


def claim_text(spark: SparkSession, path: str, text: str) -> str:
    """Create a file that holds ``text`` unless it is there, and give what the file holds.

    Of callers that ask at the same time one gets its own text back and the others that one's. A file whose writer has not
    filled it yet, or died before, gives an empty text.
    """
    system, where = _file_system(spark, path)
    if claim_path(spark, path):
        out = system.create(where, True)
        out.write(bytearray(text, "utf-8"))
        out.close()
        return text
    held = system.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(held)).decode("utf-8")
    finally:
        held.close()


def path_exists(spark: SparkSession, path: str) -> bool:
    system, where = _file_system(spark, path)
    return bool(system.exists(where))
