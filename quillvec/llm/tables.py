"""Intermediate tables in the shared folder, and keys of document rows."""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillvec.storage import hadoop_path, new_dir

LAST = 2**63 - 1


class Scratch:
    """Tables that cut the lineage of a long job: written to the shared folder and read again.

    A table survives lost executors, since all of them see the folder. ``drop`` removes one that only tables
    already written were made from.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = new_dir(spark, name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        # Spark's cleaner removes shuffle files once the JVM finds their job unreachable.
        gc.collect()
        self.spark._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path, fs = hadoop_path(self.spark, f"{self.root}/{name}")
            fs.delete(path, True)


def keyed(docs: DataFrame, *carry: str) -> DataFrame:
    """Rows of documents with a key: ``id`` is ``doc_id``, or the largest number for NULL; ``sub`` tells texts apart
    that come with the same id. Equal rows share a key, and a result as well. Columns in ``carry`` follow as ``row``.
    """
    row = [F.struct("doc_id", *[c for c in carry if c not in ("doc_id", "text")]).alias("row")]
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("sub"), *row, "text")


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def arrays(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]


def lists(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Offsets and flat fields of an array of structs; a null array counts as empty."""
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    if column.null_count:
        lengths = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, lengths)
    flat = column.flatten()
    fields = {flat.type.field(i).name: flat.field(i).to_numpy(zero_copy_only=False)
              for i in range(flat.type.num_fields)}
    return np.r_[0, np.cumsum(lengths)], fields


def spread(count: Column, most: int) -> Column:
    """Number of parts into which so many rows are dealt."""
    return F.ceil(count / F.lit(most)).cast("int")
