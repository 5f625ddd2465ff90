"""Vector profiles, the record check, and the bulk import with its rejects."""

from __future__ import annotations

import datetime as dt
import io
import re
import uuid
from dataclasses import dataclass
from itertools import islice

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillvec import model as M
from quillvec.functions.records import reject_reasons
from quillvec.functions.scalars import list_preview, plain_list_preview, text_preview
from quillvec.operators import layout
from quillvec.operators.collection import Collection, Version
from quillvec.sources.imports import footer_row_counts, path_part, read_import
from quillvec.sources.manifest import list_directory
from quillvec.storage import checkpointed, exists, new_dir, sized


OPENED = "file string, sound boolean"
OPENED_AT_ONCE = 10_000
FOOTER_ONLY_BYTES = 16 * 1024 * 1024


class ImportAborted(ValueError):
    """An import in ABORT mode met a record or a layout it does not accept."""


@dataclass
class ImportResult:
    version: Version
    segment: str
    prefix: str


def check_records(records: DataFrame, dimension: int) -> DataFrame:
    """Each record with its dimension, whether it has sparse values, and the codes of the rules it breaks."""
    return records.select(
        "namespace", "id", F.when(F.col("values").isNotNull(), F.size("values")).cast("long").alias("dimension"),
        F.col("sparse_values").isNotNull().alias("has_sparse"),
        F.array_join(reject_reasons(dimension), ",").alias("reasons"))


def vector_profile(records: DataFrame) -> DataFrame:
    """One row: rows, columns, dimensions and presence of dense, sparse and metadata values."""
    have = set(records.columns)
    size = F.when(F.col("values").isNotNull(), F.size("values")) if "values" in have else F.lit(None).cast("int")

    def present(name: str):
        return F.count(name) if name in have else F.lit(0).cast("long")

    return records.agg(
        F.count("*").alias("n_rows"), F.lit(len(records.columns)).cast("long").alias("n_columns"),
        present("values").alias("with_values"), F.min(size).cast("long").alias("min_dimension"),
        F.max(size).cast("long").alias("max_dimension"),
        F.lit("sparse_values" in have).alias("has_sparse_column"), present("sparse_values").alias("with_sparse"),
        present("metadata").alias("with_metadata"))


def dimension_histogram(records: DataFrame) -> DataFrame:
    size = F.when(F.col("values").isNotNull(), F.size("values")).cast("long")
    return records.groupBy(size.alias("dimension")).agg(F.count("*").alias("n_rows"))


def preview(records: DataFrame) -> DataFrame:
    """Every column in short form: long lists as three numbers and a length, long texts cut."""
    shown = []
    for f in records.schema:
        kind = f.dataType.typeName()
        if kind == "array" and f.dataType.elementType.typeName() in ("double", "float"):
            shown.append(list_preview(F.col(f.name)).alias(f.name))
        elif kind == "array":
            shown.append(plain_list_preview(F.col(f.name)).alias(f.name))
        elif kind == "string":
            shown.append(text_preview(F.col(f.name)).alias(f.name))
        else:
            shown.append(F.col(f.name).cast("string").alias(f.name))
    return records.select(*shown)


def first_row_preview(records: DataFrame) -> DataFrame:
    return preview(records.limit(1))


def import_check(spark: SparkSession, prefix: str) -> DataFrame:
    """The layout verdict for a live directory."""
    return layout.verdict(layout.classify(list_directory(spark, prefix), ""))


def _last_good(records: DataFrame, rules: DataFrame) -> DataFrame | None:
    """For ids that occur more than once in a namespace, the good occurrence that counts: the last by file and row.

    The search for such ids reads no vectors. Only if there are any are their records read and judged.
    """
    repeated = records.filter("id IS NOT NULL").groupBy("namespace", "id").agg(F.count("*").alias("copies")) \
        .filter("copies > 1").drop("copies")
    repeated = checkpointed(repeated)
    if repeated.isEmpty():
        return None
    good = rules.join(sized(repeated), ["namespace", "id"], "left_semi").filter("size(reasons) = 0")
    return good.groupBy("namespace", "id").agg(F.expr("max(struct(file, row_index)) AS last"))


def judged(records: DataFrame, dimension: int) -> DataFrame:
    """Records with ``reasons`` and ``kept``. Of good records with one id the last counts, the others are rejected."""
    rules = records.withColumn("reasons", reject_reasons(dimension))
    last = _last_good(records, rules)
    if last is not None:
        superseded = "size(reasons) = 0 AND last IS NOT NULL AND struct(file, row_index) <> last"
        rules = rules.join(sized(checkpointed(last)), ["namespace", "id"], "left").withColumn(
            "reasons", F.expr(f"CASE WHEN {superseded} THEN array('repeated_id') ELSE reasons END")).drop("last")
    return rules.withColumn("kept", F.expr("size(reasons) = 0")).drop("row_index")


def import_vectors(collection: Collection, prefix: str, dimension: int, error_mode: str = M.CONTINUE,
                   jobs: str | None = None, job_id: str | None = None) -> ImportResult:
    """Load ``<prefix>/<namespace>/<file>.parquet`` into a collection.

    CONTINUE loads the good records and leaves the others with the segment, see ``rejects``; it reads the input once.
    ABORT writes nothing if a record is bad, or if a file of the layout is hidden, empty or can't be read to its end: it
    looks at the layout, then at the footers, then at all records, up to the first bad one, before it writes. Without any
    file of the layout both modes fail. Records are written by the tasks that read them: a file holds one namespace, so
    nothing has to be moved.

    With ``jobs``, the states of the import are appended to a table of status events there, to be read by
    ``sources.logs.read_status_events`` while it runs and afterwards. The last one holds what was imported, or the error.
    """
    if jobs is None:
        return _import(collection, prefix, dimension, error_mode)
    job_id = job_id or uuid.uuid4().hex
    _report(collection.spark, jobs, job_id, 0, "InProgress", prefix, 0.0, 0)
    try:
        result = _import(collection, prefix, dimension, error_mode)
        loaded = collection.stored_rows(result.segment)
    except Exception as err:
        _report(collection.spark, jobs, job_id, 1, "Failed", prefix, 0.0, 0, str(err))
        raise
    _report(collection.spark, jobs, job_id, 1, "Completed", prefix, 100.0, loaded)
    return result


def _report(spark: SparkSession, jobs: str, job_id: str, seq: int, status: str, uri: str, percent: float, records: int,
            error: str | None = None) -> None:
    """Append one state of a job."""
    row = (job_id, dt.datetime.now(), seq, status, uri, percent, records, error)
    spark.createDataFrame([row], M.STATUS_EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(jobs)


def _import(collection: Collection, prefix: str, dimension: int, error_mode: str) -> ImportResult:
    spark = collection.spark
    base = collection.version()
    if base.dimension not in (None, dimension):
        raise ValueError(f"the collection holds vectors of dimension {base.dimension}, not {dimension}")
    valid = layout.classify(list_directory(spark, prefix), "").filter(F.col("class") == "valid")
    if valid.isEmpty():
        raise ImportAborted(f"{prefix} holds no file of the form <namespace>/<file>.parquet")
    if error_mode == M.ABORT:
        unread = valid.filter(_hidden(F.col("file")) | (F.col("size") == 0)).first()
        if unread is not None:
            raise ImportAborted(f"{unread.rel} is hidden or empty")
        bad = _unsound_files(spark, prefix).first()
        if bad is not None:
            raise ImportAborted(f"{bad.file} is rejected: {', '.join(bad.reasons)}")
    records = judged(read_import(spark, prefix, skip_corrupt=error_mode == M.CONTINUE), dimension)
    if error_mode == M.ABORT:
        try:
            bad = records.filter("NOT kept").select("file", "id", "reasons").first()
        except (PySparkException, Py4JJavaError) as err:
            raise ImportAborted(f"a file below {prefix} can't be read to its end: {err}") from err
        if bad is not None:
            raise ImportAborted(f"{bad.file}: record {bad.id} is rejected: {', '.join(bad.reasons)}")
    segment = collection.new_segment()
    tokens = collection.write_segment(records, segment)
    version = collection.merge(base, segment, tokens, dimension)
    return ImportResult(version, segment, prefix)


def _hidden(name):
    """Names that Spark's readers pass over."""
    return name.startswith("_") | name.startswith(".")


def rejects(collection: Collection, result: ImportResult) -> DataFrame:
    """Rejected records, and files that were not read or not read to the end: ``namespace, file, id, reasons``."""
    rows = collection.rejected(result.segment).select("namespace", "file", "id", "reasons")
    return rows.unionByName(rejected_files(collection, result))


def rejected_files(collection: Collection, result: ImportResult) -> DataFrame:
    """Files of the layout that gave fewer rows than their footer says, or no rows without being empty."""
    return _unsound_files(collection.spark, result.prefix, collection.segment_files(result.segment))


def _unsound_files(spark: SparkSession, prefix: str, rows: DataFrame | None = None) -> DataFrame:
    """Files of the layout that can't be read, and those that gave fewer ``rows`` (their ``file``) than they have.

    Only files without any row are opened once more: small ones many at a time as a whole, since such a file holds
    nothing but its footer, and those with a long footer one by one through the reader of Spark.
    """
    listed = layout.classify(list_directory(spark, prefix), "").filter(F.col("class") == "valid") \
        .select("namespace", F.col("rel").alias("file"), F.col("file").alias("name"), "size")
    known = listed.join(footer_row_counts(spark, prefix), "file", "left").fillna(0, ["n_rows"])
    if rows is None:
        known = known.withColumn("loaded", F.col("n_rows"))
    else:
        known = known.join(rows.groupBy("file").agg(F.count("*").alias("loaded")), "file", "left").fillna(0, ["loaded"])
    reason = F.when(_hidden(F.col("name")), "hidden_name").when(F.col("size") == 0, "empty_file") \
        .when(F.col("loaded") < F.col("n_rows"), "cut_short").when(F.col("n_rows") == 0, "unread")
    suspects = checkpointed(known.withColumn("reason", reason).filter(F.col("reason").isNotNull()))
    unread = suspects.filter(F.col("reason") == "unread")
    small = unread.filter(F.col("size") <= FOOTER_ONLY_BYTES)
    out = new_dir(spark, "opened")
    files = (f"{prefix.rstrip('/')}/{r.file}" for r in small.select("file").toLocalIterator())
    while paths := list(islice(files, OPENED_AT_ONCE)):
        _opened(spark, paths).write.mode("append").parquet(out)
    if exists(spark, out):
        valid = spark.read.schema(OPENED).parquet(out).filter("sound").select("file")
        suspects = suspects.join(valid, "file", "left_anti")
    sound = [r.file for r in unread.filter(F.col("size") > FOOTER_ONLY_BYTES).select("file").toLocalIterator()
             if _reads_as_empty(spark, f"{prefix.rstrip('/')}/{r.file}")]
    if sound:
        suspects = suspects.filter(~F.col("file").isin(sound))
    return suspects.selectExpr(
        "namespace", "file", "CAST(NULL AS string) AS id",
        "array(CASE WHEN reason = 'unread' THEN 'corrupt_file' ELSE reason END) AS reasons")


def _reads_as_empty(spark: SparkSession, path: str) -> bool:
    escaped = re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
    try:
        return spark.read.option("ignoreCorruptFiles", "false").parquet(escaped).isEmpty()
    except (AnalysisException, PySparkException, Py4JError):
        return False


def _opened(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Read files whole: ``sound`` is true for a valid file without rows."""
    def look(batches):
        for batch in batches:
            yield pd.DataFrame({"file": batch["file"], "sound": [_is_empty_table(c) for c in batch["content"]]})

    escaped = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]
    path = F.col("_metadata.file_path")
    return spark.read.format("binaryFile").load(escaped).select(
        F.concat(path_part(path, 2), F.lit("/"), path_part(path, 1)).alias("file"), "content") \
        .mapInPandas(look, OPENED)


def _is_empty_table(content: bytes) -> bool:
    try:
        return pq.ParquetFile(io.BytesIO(content)).metadata.num_rows == 0
    except (pa.ArrowException, OSError):
        return False
