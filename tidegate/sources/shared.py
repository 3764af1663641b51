"""The shared folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_ROOTS: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder named by the cluster. Only a session whose tasks all run in the driver may go without."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    local = tempfile.mkdtemp(prefix="tidegate-")
    spark.conf.set(CHECKPOINT_CONF, local)
    return local


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new name in the application's own folder, which goes with everything in it when the application ends."""
    root = f"{shared_dir(spark)}/tidegate-{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _ROOTS.add(root)
    return f"{root}/{purpose}-{uuid.uuid4().hex}"


def written(frame: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """The frame written to a fresh folder and read back, which cuts its lineage; and the folder."""
    path = fresh_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path), path


def kept(frame: DataFrame, purpose: str) -> DataFrame:
    return written(frame, purpose)[0]


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
