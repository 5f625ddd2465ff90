"""Pre-flight checks of an import layout, on a table of object keys and sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillvec import model as M
from quillvec.functions.scalars import megabytes
from quillvec.sources.manifest import under_prefix


def classify(manifest: DataFrame, prefix: str) -> DataFrame:
    """One class per object: ``valid``, ``bad_structure``, ``ignored`` (not parquet) or ``skipped`` (markers)."""
    start = len(prefix) + 2 if prefix else 1
    return under_prefix(manifest, prefix).selectExpr("key", "size", f"substring(key, {start}) AS rel").selectExpr(
        "*", """CASE WHEN rel = '' OR endswith(rel, '/') THEN 'skipped'
                     WHEN NOT endswith(rel, '.parquet') THEN 'ignored'
                     WHEN size(split(rel, '/')) = 2 THEN 'valid' ELSE 'bad_structure' END AS class""").selectExpr(
        "*", "CASE WHEN class = 'valid' THEN split(rel, '/')[0] END AS namespace",
        "CASE WHEN class = 'valid' THEN split(rel, '/')[1] END AS file")


def verdict(classes: DataFrame) -> DataFrame:
    """One row: object counts by class, and whether an import may go on."""
    kinds = ("valid", "bad_structure", "ignored", "skipped")
    counts = classes.agg(F.expr("count(*) AS objects"), *[F.expr(f"count_if(class = '{c}') AS {c}") for c in kinds])
    return counts.selectExpr(
        "*", "CASE WHEN valid = 0 THEN 'FAIL' WHEN bad_structure > 0 THEN 'WARN' ELSE 'PASS' END AS verdict",
        "valid > 0 AS accepted")


def totals(classes: DataFrame) -> DataFrame:
    """Files and sizes per namespace plus one total row, where ``is_total`` is true and the namespace is NULL.

    The total is rolled up from the namespace rows, so objects are aggregated once.
    """
    per_namespace = classes.filter(F.col("class") == "valid").groupBy("namespace").agg(
        F.count("*").alias("files"), F.sum(F.coalesce("size", F.lit(0))).alias("bytes"))
    return per_namespace.rollup("namespace").agg(
        (F.grouping("namespace") == 1).alias("is_total"),
        F.sum("files").alias("files"), F.sum("bytes").alias("bytes"),
    ).withColumn("size_mb", megabytes(F.col("bytes"))).orderBy("is_total", "namespace")


def first_files(classes: DataFrame, per_namespace: int = M.FILES_PER_NAMESPACE,
                bad_paths: int = M.BAD_PATHS) -> DataFrame:
    """The first files of each namespace and the first misplaced ones by key, with how many more there are.

    The rank filter turns into a group limit before the shuffle, so a hot namespace sends only a few rows
    per task. Counts come from an aggregate of their own, as a count over the window would undo that.
    """
    listed = classes.filter(F.col("class").isin("valid", "bad_structure"))
    most = max(per_namespace, bad_paths)
    limit = F.when(F.col("class") == "valid", per_namespace).otherwise(bad_paths)
    position = F.row_number().over(Window.partitionBy("class", "namespace").orderBy("key"))
    first = listed.withColumn("position", position).filter(F.col("position") <= most) \
        .withColumn("shown", limit).filter(F.col("position") <= F.col("shown")).alias("f")
    counts = listed.groupBy("class", "namespace").agg(F.count("*").alias("files")).alias("c")
    same = (F.col("f.class") == F.col("c.class")) & F.col("f.namespace").eqNullSafe(F.col("c.namespace"))
    return first.join(counts, same).select(
        "f.class", "f.namespace", F.col("position").cast("long").alias("position"), "key", "size",
        F.greatest(F.col("files") - F.col("shown"), F.lit(0)).cast("long").alias("more"),
    )
