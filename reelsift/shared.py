"""Where intermediate results go: always the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []
#: Scratch paths not removed yet, with their sessions.
_HELD: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, else its checkpoint folder.

    Where neither is set, a session of one JVM gets a local folder; on a cluster that is an error, as executors would
    write to disks that the others don't see.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="reelsift-"))
        folder = f"file://{_LOCAL[0]}"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when it is released or the driver ends."""
    path = f"{shared_dir(spark)}/reelsift-{name}-{uuid.uuid4().hex}"
    _HELD[path] = spark
    return path


def _remove(path: str) -> None:
    spark = _HELD.pop(path, None)
    if spark is None:
        return
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone already; the folder is scratch space
        return


@atexit.register
def _remove_all() -> None:
    for path in [*_HELD]:
        _remove(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors, and has an exact size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Removes tables that ``written`` made and that no later plan reads."""
    for table in tables:
        _remove(getattr(table, "_scratch", ""))


@contextmanager
def released_after() -> Iterator[list[DataFrame]]:
    """Removes, at its end, the scratch made inside, but for the written tables that are put into the list it gives."""
    before, kept = set(_HELD), []
    yield kept
    stay = before | {getattr(x, "_scratch", "") for x in kept}
    for path in [x for x in _HELD if x not in stay]:
        _remove(path)
