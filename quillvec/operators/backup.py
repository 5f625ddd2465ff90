"""Full copies of a collection and their catalogue."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvec import model as M
from quillvec.functions.scalars import backup_description, backup_name, from_token, megabytes, to_token
from quillvec.operators.collection import Collection
from quillvec.sources.logs import read_backups
from quillvec.sources.manifest import EmptyListing, list_directory


def create_backup(collection: Collection, root: str, index: str, name: str | None = None,
                  description: str | None = None, cloud: str | None = None, region: str | None = None) -> str:
    """Copy the newest version to ``<root>/<backup_id>`` and then add its catalogue row, which makes it exist.

    The row count is taken from the copy and the size from its files.
    """
    spark = collection.spark
    backup_id = uuid.uuid4().hex
    path = f"{root.rstrip('/')}/{backup_id}"
    rows = collection.read()
    rows.select("id", "values", "sparse_values", "metadata", to_token(F.col("namespace")).alias("namespace")) \
        .write.partitionBy("namespace").parquet(path)
    copied = spark.read.schema("id string").parquet(path).select("id").count()
    try:
        data = list_directory(spark, path).filter(F.col("key").endswith(".parquet"))
        size = data.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    except EmptyListing:
        size = 0
    given = F.lit(name).cast("string")
    spark.range(1).select(
        F.lit(backup_id).alias("backup_id"),
        F.coalesce(given, backup_name(F.lit(index), F.current_timestamp())).alias("name"),
        backup_description(F.lit(index), F.lit(description).cast("string")).alias("description"),
        F.lit("Ready").alias("status"), F.lit(index).alias("source_index_name"),
        F.lit(copied).cast("long").alias("record_count"), F.lit(size).cast("long").alias("size_bytes"),
        F.lit(cloud).cast("string").alias("cloud"), F.lit(region).cast("string").alias("region"),
    ).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/catalogue")
    return backup_id


def read_backup(collection: Collection, root: str, backup_id: str) -> DataFrame:
    rows = collection.spark.read.schema(M.VECTOR_SCHEMA).parquet(f"{root.rstrip('/')}/{backup_id}")
    return rows.withColumn("namespace", from_token(F.col("namespace"))).select(*M.RECORD_COLUMNS)


def list_backups(spark, root: str) -> DataFrame:
    """The catalogue with sizes in MB."""
    return read_backups(spark, root).withColumn("size_mb", megabytes(F.col("size_bytes")))
