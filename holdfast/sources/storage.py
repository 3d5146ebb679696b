"""Where jobs may write: the cluster's shared folder, never a worker's own disk."""

from __future__ import annotations

import functools
import io
import re
import tempfile
import time
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir(spark.sparkContext.applicationId)


@functools.cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"holdfast-{application}-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative jobs somewhere to cut their lineage, unless they already have it."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def kept(df: DataFrame) -> DataFrame:
    """The rows in the checkpoint folder, in the partitions and order they have, worked out once.

    Tasks that read a cached table carry the plan it was made by, and report each of its metrics to the driver; tasks that
    read this one carry and report only what comes after it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return held.checkpoint()
    finally:
        held.unpersist()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def read_small(spark: SparkSession, path: str) -> pa.Table:
    """A Parquet folder whose size does not depend on the data, such as the nodes of trees: read by the driver, without a job."""
    files, folder = _file_system(spark, path)
    parts = []
    for name in sorted(s.getPath().getName() for s in files.listStatus(folder)):
        if name.endswith(".parquet"):
            stream = files.open(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"))
            try:
                parts.append(pq.read_table(io.BytesIO(bytes(stream.readAllBytes()))))
            finally:
                stream.close()
    return pa.concat_tables(parts)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that this code made and nothing reads any more."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def replaced(spark: SparkSession, new: str, old: str) -> None:
    """Put a folder in the place of another."""
    files, target = _file_system(spark, old)
    files.delete(target, True)
    if not files.rename(spark._jvm.org.apache.hadoop.fs.Path(new), target):
        raise OSError(f"{new} could not be moved to {old}")


# --- versions of a table -------------------------------------------------------------

POINTER = "_current"
_VERSION = re.compile(r"v\d{20}-[0-9a-f]{8}")


def new_version(path: str) -> str:
    """A folder for the next version of the table at ``path``; names sort by time."""
    return f"{path.rstrip('/')}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the version that readers get, None if the table is not there."""
    pointer = f"{path.rstrip('/')}/{POINTER}"
    if not path_exists(spark, pointer):
        return None
    files, target = _file_system(spark, pointer)
    stream = files.open(target)
    try:
        name = bytes(stream.readNBytes(64)).decode()
    finally:
        stream.close()
    return f"{path.rstrip('/')}/{name}"


def make_current(spark: SparkSession, version: str, keep: int = 2) -> None:
    """Point readers at ``version``, then remove all but the ``keep`` newest versions.

    The pointer is replaced by a rename, so a reader finds the old version or the new one. The version before stays, for
    readers that have begun.
    """
    path, name = version.rsplit("/", 1)
    jvm = spark._jvm
    files, folder = _file_system(spark, path)
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}/.{POINTER}-{uuid.uuid4().hex[:8]}")
    out = files.create(fresh, True)
    out.write(bytearray(name.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fresh, jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}"), options)
    names = sorted(s.getPath().getName() for s in files.listStatus(folder) if _VERSION.fullmatch(s.getPath().getName()))
    for old in names[:-keep]:
        if old != name:
            removed(spark, f"{path}/{old}")
