"""Batch and streaming readers of operation logs, job events and the backup catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quillvec import model as M
from quillvec.storage import exists


BYTES_PER_BATCH = 1 << 30


def _read(spark: SparkSession, schema: StructType, path: str, stream: bool, files_per_batch: int | None) -> DataFrame:
    """A table, or a stream whose micro-batches are bounded by files or else by bytes."""
    if not stream:
        return spark.read.schema(schema).parquet(path)
    bound = ("maxFilesPerTrigger", files_per_batch) if files_per_batch else ("maxBytesPerTrigger", BYTES_PER_BATCH)
    return spark.readStream.schema(schema).option(*bound).parquet(path)


def read_op_log(spark: SparkSession, path: str, stream: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """Rows of an operation log, whose files may lie in a folder for each batch."""
    return _read(spark, M.OP_LOG_SCHEMA, path, stream, files_per_batch).select(*M.OP_LOG_SCHEMA.names)


def read_status_events(spark: SparkSession, path: str, stream: bool = False,
                       files_per_batch: int | None = None) -> DataFrame:
    return _read(spark, M.STATUS_EVENT_SCHEMA, path, stream, files_per_batch)


def read_backups(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the backup catalogue; none where no backup was made yet."""
    path = f"{root.rstrip('/')}/catalogue"
    if not exists(spark, path):
        return spark.createDataFrame([], M.BACKUP_SCHEMA)
    return spark.read.schema(M.BACKUP_SCHEMA).parquet(path)
