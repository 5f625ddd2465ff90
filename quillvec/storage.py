"""Shared folder, Hadoop file-system calls and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A temporary folder stands in only for a local session without that setting.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if folder is None and current is not None:
        # Spark adds one directory of its own to the folder it was given.
        folder = current.rsplit("/", 1)[0]
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quillvec-")
    if current is None:
        sc.setCheckpointDir(folder)
    return folder


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint()


def sized(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only if it holds at most ``max_rows`` rows.

    ``df`` should be checkpointed or a cheap scan, since counting it is a job of its own. The rows
    are meant to be narrow: keys and a few numbers. Beyond the bound the join shuffles.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def hadoop_path(spark: SparkSession, path: str):
    """A Hadoop path and its file system, so that any store Spark reads also works here."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = hadoop_path(spark, path)
    return fs.exists(jpath)


def child_names(spark: SparkSession, path: str) -> list[str]:
    jpath, fs = hadoop_path(spark, path)
    if not fs.exists(jpath):
        return []
    return [s.getPath().getName() for s in fs.listStatus(jpath)]


def write_once(spark: SparkSession, path: str, data: bytes) -> None:
    """Give ``path`` the content ``data`` at once; fails if it is there already.

    The content is written under another name and renamed, so that nobody sees part of it. The rename never
    replaces a file.
    """
    jpath, fs = hadoop_path(spark, path)
    draft, _ = hadoop_path(spark, f"{path.rpartition('/')[0]}/.{path.rpartition('/')[2]}-{uuid.uuid4().hex[:12]}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    none = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        hadoop.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, jpath, none)
    except Exception:
        fs.delete(draft, False)
        raise


def read_text(spark: SparkSession, path: str) -> str:
    jpath, fs = hadoop_path(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
