"""Session-level plumbing: table access, shared scratch space, size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that a staged table may have on disk to be broadcast.
BROADCAST_BYTES = 16 << 20
_STAGED: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once_per(df: DataFrame, *keys: str) -> DataFrame:
    """One row for each key; for rows that are equal wherever their keys are (a page delivered again)."""
    return df.dropDuplicates(list(keys))


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir``. Only a local session may go without; it gets a temporary folder."""
    own = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not own:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quire-")
        atexit.register(shutil.rmtree, folder, True)
        own = "file://" + folder
        spark.sparkContext.setCheckpointDir(own)
    return own.rstrip("/")


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the table: lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quire-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release(since: int = 0) -> None:
    """Delete the tables staged since the given number of them."""
    while len(_STAGED) > since:
        spark, path = _STAGED.pop()
        if spark.sparkContext._jsc is not None:
            p, fs = _path(spark, path)
            fs.delete(p, True)


@contextmanager
def scope():
    """Tables staged inside are deleted at the end; results that read them must be written or collected by then."""
    since = len(_STAGED)
    try:
        yield
    finally:
        release(since)


def _at_exit() -> None:
    try:
        release()
    except Exception:  # noqa: BLE001  the session is gone; the folder belongs to the cluster's housekeeping
        pass


atexit.register(_at_exit)


def narrow(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a staged table of at most ``limit`` bytes on disk; beyond that the table as it is, for a shuffled join."""
    files = df.inputFiles()
    size = 0
    for f in files:
        p, fs = _path(df.sparkSession, f)
        size += fs.getFileStatus(p).getLen()
    return F.broadcast(df) if files and size <= limit else df
