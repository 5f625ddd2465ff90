"""Reproducible synthetic vectors and write batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillvec import model as M
from quillvec.storage import checkpointed

# The integer mixing rule. Every product stays below 2^62, so any engine can repeat it exactly.
MODULUS = 2_147_483_647
ROW_FACTOR, HIGH_FACTOR, COLUMN_FACTOR, SALT_FACTOR = 48_271, 40_692, 69_621 * 7_919, 16_807
MIX_FACTOR, MIX_ADD = 1_343_714_438, 1_267_836_241
ROUNDS = 3


def uniform_block(numbers: np.ndarray, dimension: int, salt: int) -> np.ndarray:
    """Values in [-1, 1): element j of row i is a hash of (i, j, salt), the same in every run and split."""
    i = np.asarray(numbers, np.int64)
    j = np.arange(1, dimension + 1, dtype=np.int64)
    row = i % MODULUS * ROW_FACTOR + i // MODULUS * HIGH_FACTOR + salt * SALT_FACTOR
    h = (row[:, None] + j[None, :] * COLUMN_FACTOR) % MODULUS
    for _ in range(ROUNDS):
        h = (h * h % MODULUS + h * MIX_FACTOR + MIX_ADD) % MODULUS
    return h / 1_073_741_823.5 - 1.0


def with_values(numbered: DataFrame, number: str, dimension: int, salt: int) -> DataFrame:
    """Add ``values`` to rows that carry a whole number. Numbers go through Arrow in blocks; nothing is shuffled."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                block = uniform_block(part.column(number).to_numpy(zero_copy_only=False), dimension, salt)
                offsets = pa.array(np.arange(0, block.size + 1, dimension, dtype=np.int32))
                values = pa.ListArray.from_arrays(offsets, pa.array(block.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, values], names=[*part.schema.names, "values"])

    return numbered.mapInArrow(fill, f"{columns}, values array<double>")


def numbers(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "number")


def batch_of(position: Column, size: int = M.BATCH_SIZE) -> Column:
    return F.floor(position / size).cast("long")


def synthetic_vectors(numbered: DataFrame, dimension: int = M.VECTOR_DIMENSION, salt: int = 0) -> DataFrame:
    """Records ``vec-<number>`` with uniform values and their batch in the metadata."""
    batch = F.concat(F.lit('{"batch_id": '), batch_of(F.col("number")).cast("string"), F.lit("}"))
    return with_values(numbered.select("number"), "number", dimension, salt).select(
        F.concat(F.lit("vec-"), F.col("number").cast("string")).alias("id"), "values", batch.alias("metadata"))


def query_vectors(numbered: DataFrame, dimension: int = M.VECTOR_DIMENSION, salt: int = 1) -> DataFrame:
    """Query vectors of the same kind; another salt keeps them apart from the records."""
    return with_values(numbered.select("number"), "number", dimension, salt).select(
        F.col("number").alias("qid"), F.col("values").alias("qv"))


def constant_records(namespaces: DataFrame, dimension: int = M.VECTOR_DIMENSION, value: float = 0.1) -> DataFrame:
    """One test record with equal values for each namespace."""
    return namespaces.select(
        "namespace", F.lit("test-vector-1").alias("id"), F.array_repeat(F.lit(value), dimension).alias("values"),
        F.lit('{"description": "Test vector for demonstration"}').alias("metadata"))


def positions(rows: DataFrame, *order: Column | str) -> DataFrame:
    """Rows with ``position``, numbered densely from 0 in the given order; ties follow each other in any order.

    Rows are dealt out by ranges and numbered inside a range, which is written before the numbers are used; the only
    window without a key runs over the counts of the ranges, one row for each partition.
    """
    ordered = checkpointed(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                           .withColumn("place", F.monotonically_increasing_id()))
    # The upper bits of that number are the partition, the lower 33 the row in it.
    part, row = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    return ordered.withColumn("part", part).join(F.broadcast(shifts), "part") \
        .withColumn("position", (row + F.col("shift")).cast("long")).drop("part", "place", "shift")


def write_batches(records: DataFrame, id_col: str = "id", size: int = M.BATCH_SIZE) -> DataFrame:
    """Number records densely in the order of ``id_col`` and cut them into batches of ``size``; only the last one can
    be short. Records with the same id, or none, follow each other in any order."""
    return positions(records, id_col).withColumn("batch", batch_of(F.col("position"), size))


def batch_sizes(batches: DataFrame) -> DataFrame:
    return batches.groupBy("batch").agg(F.count("*").alias("n_rows"))
