"""Shared working folder of a session."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the checkpoint folder of the session, with its scheme.

    The session's ``spark.checkpoint.dir`` decides where it is. A temporary folder of this
    machine stands in for it only where the master is local, as in unit tests; on a cluster,
    whose executors could not read it, a missing setting is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not is_local(context.master):
            raise ValueError(
                "spark.checkpoint.dir names no folder; on a cluster it has to be one that the "
                "driver and all executors share"
            )
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="lading-"))
    return context.getCheckpointDir().rstrip("/")


def is_local(master: str) -> bool:
    """Whether driver and executors are one process on one machine."""
    return master == "local" or master.startswith("local[")


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path under the shared folder; removed when the driver ends."""
    path = f"{shared_dir(spark)}/lading-{label}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_remove_made)
    _made.append((spark, path))
    return path


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written as Parquet to a fresh shared folder and read back.

    Cuts the lineage: what follows reads files that outlive any executor.
    """
    spark = frame.sparkSession
    path = new_run_dir(spark, label)
    frame.write.parquet(path)
    read = spark.read.schema(frame.schema).parquet(path)
    _paths[read] = path
    return read


def discard(frame: DataFrame) -> None:
    """Removes what ``stored`` wrote for ``frame``, which nothing may read any more."""
    path = _paths.pop(frame, None)
    if path is not None:
        remove(frame.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder with all it holds; one that is not there is no error."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def _remove_made() -> None:
    while _made:
        try:
            remove(*_made.pop())
        except Exception:  # the JVM may have gone first; the folder then stays
            return
