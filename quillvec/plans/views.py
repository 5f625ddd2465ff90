"""The driver's tables seen as collections, logs, listings and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillvec import model as M
from quillvec.operators.generate import positions
from quillvec.storage import child_names, hadoop_path

DIMENSION = 64
PREFIX = "import"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _namespace(number: str) -> str:
    return f"CASE WHEN {number} = 0 THEN '{M.DEFAULT_NAMESPACE}' ELSE concat('ns-', {number}) END AS namespace"


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").selectExpr(
        _namespace("label"), "string(vec_id) AS id", "CAST(embedding AS array<double>) AS values")


def search_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors as stored: a search widens the elements itself."""
    return table(spark, sf, "embeddings").selectExpr(_namespace("label"), "string(vec_id) AS id", "embedding AS values")


def records(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors as complete collection records."""
    return table(spark, sf, "embeddings").selectExpr(
        _namespace("label"), "string(vec_id) AS id", "CAST(embedding AS array<double>) AS values",
        "CASE WHEN vec_id % 3 = 0 THEN named_struct('indices', array(vec_id, vec_id + 1), "
        "'values', array(0.5D, 0.25D)) END AS sparse_values",
        """concat('{"batch_id": ', vec_id DIV 100, '}') AS metadata""", "vec_id AS number")


def partly_faulty(spark: SparkSession, sf: str) -> DataFrame:
    """The records, numbered densely by id, a few without an id and a few with a NaN."""
    placed = positions(records(spark, sf), "number").drop("number")
    return placed.selectExpr(
        "namespace", "CASE WHEN position % 310 <> 7 THEN id END AS id",
        "CASE WHEN position % 470 = 21 THEN concat(array(double('NaN')), slice(values, 2, size(values) - 1)) "
        "ELSE values END AS values", "sparse_values", "metadata", "position AS number")


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    """The records with faults planted by number: missing ids and values, wrong lengths, NaN, NULL elements, repeats.

    A directory needs a name, so the default namespace goes by ``ns-0`` here.
    """
    rest = f"slice(values, 2, {DIMENSION - 1})"
    faulty = records(spark, sf).selectExpr(
        "CASE WHEN namespace = '' THEN 'ns-0' ELSE namespace END AS namespace",
        "CASE WHEN number % 25 <> 0 THEN id END AS id",
        f"""CASE number % 25 WHEN 1 THEN NULL WHEN 2 THEN slice(values, 1, {DIMENSION - 1})
            WHEN 3 THEN concat(array(double('NaN')), {rest})
            WHEN 4 THEN concat(array(CAST(NULL AS double)), {rest}) ELSE values END AS values""",
        "sparse_values", "metadata", "number")
    return faulty.unionByName(faulty.filter("number % 25 = 5")).drop("number")


def queries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").selectExpr("vec_id AS qid", "embedding AS qv")


def changes(spark: SparkSession, sf: str) -> DataFrame:
    """Every third vector negated, an older change to each of them, and as many new ids; as complete records."""
    third = vectors(spark, sf).filter("bigint(id) % 3 = 0")
    nothing = [f"CAST(NULL AS {M.SPARSE.simpleString()}) AS sparse_values", "CAST(NULL AS string) AS metadata"]
    return third.selectExpr("namespace", "id", "transform(values, x -> -x) AS values", *nothing, "2L AS seq") \
        .unionByName(third.selectExpr("namespace", "id", "transform(values, x -> x * 2) AS values", *nothing,
                                      "1L AS seq")) \
        .unionByName(third.selectExpr("namespace", "concat('new-', id) AS id", "values", *nothing, "1L AS seq"))


def op_log(events: DataFrame) -> DataFrame:
    """Events as operations: one run per day, 24 namespaces, ``error`` events as failed operations."""
    return events.selectExpr(
        "concat('run-', date_format(ts, 'yyyy-MM-dd')) AS run_id", "event_id AS op_id", "ts", "'query' AS op",
        _namespace("(user_id % 24)"), "100L AS n_rows", "event_type <> 'error' AS success", "value AS latency_ms")


def status_events(events: DataFrame) -> DataFrame:
    """Events as states of one job per user: purchases complete a job, errors fail it."""
    return events.selectExpr(
        "concat('job-', user_id) AS job_id", "ts", "event_id AS seq",
        """CASE event_type WHEN 'purchase' THEN 'Completed' WHEN 'error' THEN 'Failed'
           WHEN 'signup' THEN 'Pending' ELSE 'InProgress' END AS status""",
        "concat('s3://bucket/', user_id) AS uri",
        "CASE event_type WHEN 'purchase' THEN 100D WHEN 'view' THEN 50D END AS percent_complete",
        "CASE WHEN event_type <> 'error' THEN floor(value / 50) END AS records_imported",
        "CASE WHEN event_type = 'error' THEN props END AS error")


def backup_events(events: DataFrame) -> DataFrame:
    """The same events as states of backups, which end by being ready."""
    return status_events(events).withColumn(
        "status", F.when(F.col("status") == M.IMPORT_TERMINAL[0], M.BACKUP_TERMINAL[0]).otherwise(F.col("status")))


def arrivals(spark: SparkSession, sf: str, slices: int) -> list[DataFrame]:
    """Events in the order in which they arrive, cut into ``slices``: each up to the length of a slice late."""
    all_ = events(spark, sf)
    ends = all_.agg(F.min("ts").alias("from_ts"), F.max("ts").alias("to_ts"))  # one row
    us = "timestampdiff(MICROSECOND, {}, {})".format
    place = f"{us('from_ts', 'ts')} * {slices}D / {us('from_ts', 'to_ts')} + pmod(xxhash64(event_id), 1000) / 1001"
    placed = all_.join(F.broadcast(ends), how="cross").withColumn("slice", F.expr(f"least(floor({place}), {slices - 1})"))
    return [placed.filter(F.col("slice") == i).select(all_.columns) for i in range(slices)]


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """One object per document; the last digit of the id decides the shape of its key."""
    return table(spark, sf, "documents").selectExpr(
        f"""CASE doc_id % 10
              WHEN 0 THEN concat('{PREFIX}/f', doc_id, '.parquet')
              WHEN 1 THEN concat('{PREFIX}/', source, '/x/f', doc_id, '.parquet')
              WHEN 2 THEN concat('{PREFIX}/', source, '/f', doc_id, '.txt')
              WHEN 3 THEN concat('{PREFIX}/', source, '/')
              WHEN 4 THEN concat('{PREFIX}//f', doc_id, '.parquet')
              ELSE concat('{PREFIX}/', source, '/f', doc_id, '.parquet') END AS key""",
        "n_chars AS size")


def import_requests(spark: SparkSession, sf: str) -> DataFrame:
    """One import request per page, in every address shape for every environment."""
    environments = ", ".join(f"'{e}'" for e in M.ENVIRONMENTS)
    parts = table(spark, sf, "pages").selectExpr(
        "page_id", "url", "regexp_extract(url, '^https?://([^/]+)', 1) AS host",
        "regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path")
    return parts.selectExpr(
        "page_id AS request_id",
        f"element_at(array({environments}), int(page_id DIV 8 % {len(M.ENVIRONMENTS)} + 1)) AS env",
        """CASE page_id % 8
             WHEN 0 THEN concat('s3://', host, '/', path)
             WHEN 1 THEN concat('s3://arn:aws:s3:us-east-1:', page_id, ':accesspoint/', host, '/', path)
             WHEN 2 THEN concat('gs://', host, '/', path, '//')
             WHEN 3 THEN concat('azure://', host, '/', path)
             WHEN 4 THEN concat('https://acct', page_id, '.blob.core.windows.net/c', page_id, '/', path)
             WHEN 5 THEN url WHEN 6 THEN concat('s3://', host) ELSE 's3://' END AS uri""",
        "element_at(array('c', 'Abort', ' a', ''), int(page_id % 4 + 1)) AS error_mode")


def numbered(spark: SparkSession, sf: str) -> DataFrame:
    """One number per document, as the input of the generators."""
    return table(spark, sf, "documents").select(F.col("doc_id").alias("number"))


def write_import_layout(rows: DataFrame, prefix: str) -> None:
    """Write records as ``<prefix>/<namespace>/<file>.parquet``, one directory per namespace.

    Spark names partition directories ``column=value``; they are renamed, which moves no data.
    """
    spark = rows.sparkSession
    rows.write.partitionBy("namespace").parquet(prefix)
    for name in child_names(spark, prefix):
        if name.startswith("namespace="):
            source, fs = hadoop_path(spark, f"{prefix}/{name}")
            fs.rename(source, hadoop_path(spark, f"{prefix}/{name.split('=', 1)[1]}")[0])
