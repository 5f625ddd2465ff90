"""Schemas and fixed names of the data model."""

from pyspark.sql import types as T

# Names and settings that results depend on.
DEFAULT_NAMESPACE = ""
DEFAULT_NAMESPACE_LABEL = "(default)"
VECTOR_DIMENSION = 1024
BATCH_SIZE = 100
TOP_K = 10
HOT_NAMESPACES = 20
FILES_PER_NAMESPACE = 3
BAD_PATHS = 5
REPRINT_SECONDS = 30
PREVIEW_LIST = 5
PREVIEW_SHOWN = 3
PREVIEW_TEXT = 200
BYTES_PER_MB = 1024 * 1024
IMPORT_TERMINAL = ("Completed", "Failed", "Cancelled")
BACKUP_TERMINAL = ("Ready", "Failed", "Cancelled")
ENVIRONMENTS = ("byoc-aws", "byoc-gcp", "byoc-azure", "saas")
CONTINUE, ABORT = "CONTINUE", "ABORT"

# A partition directory cannot hold the empty string, so the default namespace is stored as a token.
DEFAULT_TOKEN = "__default__"

SPARSE = T.StructType([
    T.StructField("indices", T.ArrayType(T.LongType())),
    T.StructField("values", T.ArrayType(T.DoubleType())),
])

RECORD_FIELDS = [
    T.StructField("id", T.StringType()),
    T.StructField("values", T.ArrayType(T.DoubleType())),
    T.StructField("sparse_values", SPARSE),
    T.StructField("metadata", T.StringType()),
]

IMPORT_SCHEMA = T.StructType(RECORD_FIELDS)
VECTOR_SCHEMA = T.StructType([T.StructField("namespace", T.StringType()), *RECORD_FIELDS])
RECORD_COLUMNS = [f.name for f in VECTOR_SCHEMA]

MANIFEST_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("size", T.LongType()),
])

OP_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("op_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("op", T.StringType()),
    T.StructField("namespace", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("latency_ms", T.DoubleType()),
])

STATUS_EVENT_SCHEMA = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("uri", T.StringType()),
    T.StructField("percent_complete", T.DoubleType()),
    T.StructField("records_imported", T.LongType()),
    T.StructField("error", T.StringType()),
])

BACKUP_SCHEMA = T.StructType([
    T.StructField("backup_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("source_index_name", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("cloud", T.StringType()),
    T.StructField("region", T.StringType()),
])
