"""Object listings as tables of key and size."""

from __future__ import annotations

from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillvec import model as M
from quillvec.storage import exists, hadoop_path, new_dir


class EmptyListing(ValueError):
    """Nothing lies under the listed prefix."""


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """A store's inventory table: the form to use for large prefixes."""
    return spark.read.schema(M.MANIFEST_SCHEMA).parquet(path)


def under_prefix(manifest: DataFrame, prefix: str) -> DataFrame:
    return manifest.filter(F.col("key").startswith(f"{prefix}/")) if prefix else manifest


def _walk(spark: SparkSession, root: str):
    jroot, fs = hadoop_path(spark, root)
    base = fs.makeQualified(jroot).toUri().getPath().rstrip("/") + "/"
    found = fs.listFiles(jroot, True)
    while found.hasNext():
        status = found.next()
        yield status.getPath().toUri().getPath()[len(base):], status.getLen()


def list_directory(spark: SparkSession, root: str, chunk: int = 100_000) -> DataFrame:
    """Every file below ``root``, hidden and empty ones included, with the key relative to ``root``.

    Only the file system client sees such files, so the listing runs on the driver; it goes to the shared
    folder in chunks, and the driver never holds more than one of them.
    """
    files = _walk(spark, root) if exists(spark, root) else iter(())
    out = new_dir(spark, "manifest")
    empty = True
    while rows := list(islice(files, chunk)):
        empty = False
        part = pd.DataFrame(rows, columns=["key", "size"])
        spark.createDataFrame(part, M.MANIFEST_SCHEMA).write.mode("append").parquet(out)
    if empty:
        raise EmptyListing(f"no objects found under '{root}'")
    return read_inventory(spark, out)
