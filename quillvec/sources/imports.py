"""Reading vector files: the namespaced import layout and single parquet files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillvec import model as M


def path_part(path: Column, from_end: int) -> Column:
    """A decoded component of a file path, counted from the end (1 = the file name)."""
    raw = F.try_element_at(F.split(path, "/"), F.lit(-from_end))
    # url_decode reads "+" as a blank, which is right for forms and wrong for paths.
    return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def import_files(prefix: str) -> str:
    return prefix.rstrip("/") + "/*/*.parquet"


def read_import(spark: SparkSession, prefix: str, skip_corrupt: bool = False) -> DataFrame:
    """Records of every ``<prefix>/<namespace>/<file>.parquet``; the directory name is the namespace.

    Files at other depths are not read. Columns a file lacks are NULL. ``file`` is the key relative to the
    prefix and ``row_index`` the position in the file.
    """
    reader = spark.read.schema(M.IMPORT_SCHEMA).option("ignoreCorruptFiles", str(skip_corrupt).lower())
    try:
        files = reader.parquet(import_files(prefix))
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], M.IMPORT_SCHEMA).select(
            "*", F.struct(F.lit("").alias("file_path"), F.lit(0).cast("long").alias("row_index")).alias("_metadata"))
    path = F.col("_metadata.file_path")
    namespace = path_part(path, 2)
    return files.select(
        namespace.alias("namespace"), "id", "values", "sparse_values", "metadata",
        F.concat(namespace, F.lit("/"), path_part(path, 1)).alias("file"),
        F.col("_metadata.row_index").alias("row_index"),
    )


def footer_row_counts(spark: SparkSession, prefix: str) -> DataFrame:
    """Rows per readable file. No data column is read, so the counts come from the file footers."""
    return read_import(spark, prefix, skip_corrupt=True).groupBy("file").agg(F.count("*").alias("n_rows"))


def read_vector_file(spark: SparkSession, path: str) -> DataFrame:
    """One parquet file as it is, with the schema its footer carries."""
    return spark.read.parquet(path)
