"""Expected results of the named queries, as SQL over the same tables."""

from __future__ import annotations

from quillvec import model as M
from quillvec.functions.uris import URI_PATTERNS
from quillvec.operators import generate as G
from quillvec.plans.registry import TICK_SECONDS
from quillvec.plans.views import DIMENSION, PREFIX

VECTORS = """
vectors AS (
  SELECT CASE WHEN label = 0 THEN '' ELSE 'ns-' || label END AS namespace,
         CAST(vec_id AS VARCHAR) AS id, embedding::DOUBLE[] AS "values", vec_id AS number
  FROM embeddings)"""

RAW = f"""
faulty AS (
  SELECT 'ns-' || label AS namespace, CASE WHEN vec_id % 25 <> 0 THEN CAST(vec_id AS VARCHAR) END AS id,
         CASE vec_id % 25 WHEN 1 THEN NULL
              WHEN 2 THEN (embedding::DOUBLE[])[1:{DIMENSION - 1}]
              WHEN 3 THEN list_concat(['nan'::DOUBLE], (embedding::DOUBLE[])[2:{DIMENSION}])
              WHEN 4 THEN list_concat([NULL::DOUBLE], (embedding::DOUBLE[])[2:{DIMENSION}])
              ELSE embedding::DOUBLE[] END AS "values",
         CASE WHEN vec_id % 3 = 0 THEN [vec_id, vec_id + 1] END AS sparse_indices,
         '{{"batch_id": ' || (vec_id // 100) || '}}' AS metadata, vec_id AS number
  FROM embeddings),
raw AS (SELECT *, 1 AS copy FROM faulty UNION ALL SELECT *, 2 AS copy FROM faulty WHERE number % 25 = 5),
checked AS (
  SELECT *, concat_ws(',',
    CASE WHEN id IS NULL THEN 'missing_id' END,
    CASE WHEN "values" IS NULL THEN 'missing_values' END,
    CASE WHEN len("values") <> {DIMENSION} THEN 'wrong_dimension' END,
    CASE WHEN len(list_filter("values", lambda x: x IS NULL OR isnan(x) OR isinf(x))) > 0 THEN 'bad_value' END
  ) AS reasons FROM raw)"""

CHANGED = """
third AS (SELECT * FROM vectors WHERE number % 3 = 0),
changed AS (
  SELECT namespace, id, "values" FROM vectors WHERE number % 3 <> 0
  UNION ALL SELECT namespace, id, list_transform("values", lambda x: -x) FROM third
  UNION ALL SELECT namespace, 'new-' || id, "values" FROM third)"""

MANIFEST = f"""
manifest AS (
  SELECT CASE doc_id % 10
           WHEN 0 THEN '{PREFIX}/f' || doc_id || '.parquet'
           WHEN 1 THEN '{PREFIX}/' || source || '/x/f' || doc_id || '.parquet'
           WHEN 2 THEN '{PREFIX}/' || source || '/f' || doc_id || '.txt'
           WHEN 3 THEN '{PREFIX}/' || source || '/'
           WHEN 4 THEN '{PREFIX}//f' || doc_id || '.parquet'
           ELSE '{PREFIX}/' || source || '/f' || doc_id || '.parquet' END AS key,
         n_chars AS size
  FROM documents),
relative AS (SELECT *, substring(key, {len(PREFIX) + 2}) AS rel FROM manifest WHERE starts_with(key, '{PREFIX}/')),
classes AS (
  SELECT key, size, rel,
         CASE WHEN rel = '' OR ends_with(rel, '/') THEN 'skipped'
              WHEN NOT ends_with(rel, '.parquet') THEN 'ignored'
              WHEN len(string_split(rel, '/')) = 2 THEN 'valid' ELSE 'bad_structure' END AS class
  FROM relative),
named AS (
  SELECT key, size, rel, class,
         CASE WHEN class = 'valid' THEN string_split(rel, '/')[1] END AS namespace,
         CASE WHEN class = 'valid' THEN string_split(rel, '/')[2] END AS file
  FROM classes)"""

REQUESTS = r"""
parts AS (
  SELECT *, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
         regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path FROM pages),
requests AS (
  SELECT page_id AS request_id,
         ['byoc-aws', 'byoc-gcp', 'byoc-azure', 'saas'][page_id // 8 % 4 + 1] AS env,
         ['c', 'Abort', ' a', ''][page_id % 4 + 1] AS error_mode,
         CASE page_id % 8
           WHEN 0 THEN 's3://' || host || '/' || path
           WHEN 1 THEN 's3://arn:aws:s3:us-east-1:' || page_id || ':accesspoint/' || host || '/' || path
           WHEN 2 THEN 'gs://' || host || '/' || path || '//'
           WHEN 3 THEN 'azure://' || host || '/' || path
           WHEN 4 THEN 'https://acct' || page_id || '.blob.core.windows.net/c' || page_id || '/' || path
           WHEN 5 THEN url WHEN 6 THEN 's3://' || host ELSE 's3://' END AS uri
  FROM parts)"""

LOG = """
op_log AS (
  SELECT 'run-' || strftime(ts, '%Y-%m-%d') AS run_id, ts, epoch_us(ts) AS us,
         CASE WHEN user_id % 24 = 0 THEN '' ELSE 'ns-' || (user_id % 24) END AS namespace,
         100 AS n_rows, event_type <> 'error' AS success, value AS latency_ms
  FROM events)"""

BY_NAMESPACE = LOG + """,
grouped AS (
  SELECT namespace, count(*) FILTER (success) AS queries, count(*) FILTER (NOT success) AS errors,
         CAST(sum(latency_ms::DECIMAL(18, 6)) FILTER (success) AS DOUBLE) / count(*) FILTER (success) AS avg_ms, list_sort(list(latency_ms) FILTER (success)) AS l
  FROM op_log GROUP BY namespace),
by_namespace AS (
  SELECT namespace, queries, errors, avg_ms,
         (l[(queries - 1) // 2 + 1] + l[queries // 2 + 1]) / 2 AS p50_ms
  FROM grouped WHERE queries > 0)"""

EVENTS = """
status_events AS (
  SELECT 'job-' || user_id AS job_id, ts, epoch_us(ts) AS us, event_id AS seq,
         CASE event_type WHEN 'purchase' THEN 'Completed' WHEN 'error' THEN 'Failed'
                         WHEN 'signup' THEN 'Pending' ELSE 'InProgress' END AS status,
         's3://bucket/' || user_id AS uri,
         CASE event_type WHEN 'purchase' THEN 100.0::DOUBLE WHEN 'view' THEN 50.0::DOUBLE END AS percent_complete,
         CASE WHEN event_type <> 'error' THEN CAST(floor(value / 50) AS BIGINT) END AS records_imported,
         CASE WHEN event_type = 'error' THEN props END AS error
  FROM events),
terminal AS (SELECT *, status IN ('Completed', 'Failed', 'Cancelled') AS done FROM status_events),
annotated AS (
  SELECT *, row_number() OVER w AS place, lag(status) OVER w AS p_status, lag(uri) OVER w AS p_uri,
         lag(percent_complete) OVER w AS p_percent, lag(records_imported) OVER w AS p_records,
         lag(error) OVER w AS p_error, (us - first(us) OVER w) // 1000000 AS elapsed,
         coalesce(bool_or(done) OVER (PARTITION BY job_id ORDER BY ts, seq
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS over_before
  FROM terminal WINDOW w AS (PARTITION BY job_id ORDER BY ts, seq)),
watched AS (SELECT * FROM annotated WHERE NOT over_before)"""

OUTCOMES = EVENTS + """,
firsts AS (SELECT job_id, min(us) AS created_us FROM status_events GROUP BY job_id),
ends AS (
  SELECT * FROM annotated WHERE NOT over_before
  QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY done DESC, ts DESC, seq DESC) = 1),
outcomes AS (
  SELECT job_id, status, done, elapsed, coalesce(uri, 'N/A') AS uri,
         CASE WHEN percent_complete IS NULL THEN 'N/A' ELSE printf('%.1f%%', percent_complete) END AS progress,
         coalesce(records_imported, 0) AS records_imported, error, created_us,
         CASE WHEN done THEN us ELSE -1 END AS finished_us
  FROM ends JOIN firsts USING (job_id))"""


def uniform(number: str, dimension: int, salt: int) -> str:
    """The generator's values for one number, in exact integer arithmetic."""
    m = G.MODULUS
    mixed = (f"list_transform(range(1, {dimension + 1}), lambda j: ({number} % {m} * {G.ROW_FACTOR} + "
             f"{number} // {m} * {G.HIGH_FACTOR} + {salt * G.SALT_FACTOR} + j * {G.COLUMN_FACTOR}) % {m})")
    for _ in range(G.ROUNDS):
        mixed = f"list_transform({mixed}, lambda h: (h * h % {m} + h * {G.MIX_FACTOR} + {G.MIX_ADD}) % {m})"
    return f"list_transform({mixed}, lambda h: h / 1073741823.5::DOUBLE - 1.0::DOUBLE)"


def flat(sql: str, others: str, vector: str = '"values"') -> str:
    """The numbers that stand for a vector column, see ``registry.flat``."""
    return f"""
SELECT {others}, CAST(len({vector}) AS BIGINT) AS dimension, {vector}[1] AS first_value,
       {vector}[len({vector})] AS last_value,
       round(list_inner_product({vector}, list_transform(range(1, len({vector}) + 1), lambda i: i::DOUBLE)), 6) AS weighted
FROM ({sql})"""


def stats(rows: str) -> str:
    return f"""
SELECT namespace, grouping(namespace) = 1 AS is_total, count(*) AS vector_count,
       CAST(max(len("values")) AS BIGINT) AS dimension
FROM ({rows}) GROUP BY ROLLUP (namespace)"""


LATENCY = """
count(*) FILTER (success) AS operations, count(*) FILTER (NOT success) AS errors,
(max(us) - min(us)) / 1e6::DOUBLE AS elapsed, CAST(sum(latency_ms::DECIMAL(18, 6)) FILTER (success) AS DOUBLE) / count(*) FILTER (success) AS avg_ms,
list_sort(list(latency_ms) FILTER (success)) AS l"""

SUMMARY = """
operations, errors, round(elapsed, 6) AS elapsed_sec,
round(CASE WHEN elapsed > 0 THEN operations / elapsed END, 6) AS ops_per_sec, round(avg_ms, 6) AS avg_ms,
round((l[(operations - 1) // 2 + 1] + l[operations // 2 + 1]) / 2, 6) AS p50_ms,
round(l[CAST(floor(operations * 0.95::DOUBLE) AS BIGINT) + 1], 6) AS p95_ms,
round(l[CAST(floor(operations * 0.99::DOUBLE) AS BIGINT) + 1], 6) AS p99_ms,
round(l[1], 6) AS min_ms, round(l[len(l)], 6) AS max_ms"""

BATCHES = """
placed AS (
  SELECT doc_id AS number, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents)"""

UPSERTED = f"WITH {VECTORS}, {CHANGED} {flat('SELECT * FROM changed', 'namespace, id')}"

STATUS_CHANGES = f"""
WITH {EVENTS}
SELECT job_id, seq, status, elapsed FROM watched
WHERE status IS DISTINCT FROM p_status OR elapsed % {M.REPRINT_SECONDS} = 0"""

def uri_part(group: int) -> str:
    cases = " ".join(f"WHEN regexp_matches(u, '{p}') THEN regexp_extract(u, '{p}', {group})" for p in URI_PATTERNS)
    return f"CASE {cases} END"


ORACLES = {
    "topk_all_namespaces": f"""
WITH {VECTORS}, scored AS (
  SELECT q.number AS qid, v.namespace, v.id, list_inner_product(v."values", q."values") AS score
  FROM vectors q, vectors v),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid, namespace ORDER BY score DESC, id) AS rank FROM scored)
SELECT qid, namespace, id, round(score, 6) AS score, rank FROM ranked WHERE rank <= {M.TOP_K}""",

    "topk_routed": f"""
WITH {VECTORS}, scored AS (
  SELECT q.number AS qid, v.namespace, v.id, q.number % 4 + 1 AS top_k,
         list_inner_product(v."values", q."values") AS score
  FROM vectors q JOIN vectors v ON v.namespace = 'ns-' || (q.number % 9 + 1)
  WHERE q.number % 7 NOT IN (1, 2, 3, 4)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid, namespace ORDER BY score DESC, id) AS rank FROM scored)
SELECT qid, namespace, id, round(score, 6) AS score, rank FROM ranked WHERE rank <= top_k""",

    "topk_one_namespace": f"""
WITH {VECTORS}, scored AS (
  SELECT q.number AS qid, v.id, list_inner_product(v."values", q."values")
         / sqrt(list_inner_product(v."values", v."values") * list_inner_product(q."values", q."values")) AS score
  FROM vectors q, vectors v WHERE v.namespace = 'ns-3'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM scored)
SELECT qid, id, round(score, 6) AS score, rank FROM ranked WHERE rank <= {M.TOP_K}""",

    "topk_default_namespace": f"""
WITH {VECTORS}, query AS (SELECT list_transform({uniform('0', DIMENSION, 1)}, lambda x: x / 8) AS qv),
scored AS (
  SELECT v.id, -list_distance(v."values", q.qv) AS score FROM vectors v, query q WHERE v.namespace = '')
SELECT id, round(score, 6) AS score FROM (SELECT * FROM scored ORDER BY score DESC, id LIMIT {M.TOP_K})""",

    "collection_stats": f"WITH {VECTORS} {stats('SELECT * FROM vectors')}",

    "vector_profile": f"""
WITH {RAW}
SELECT count(*) AS n_rows, 5::BIGINT AS n_columns, count("values") AS with_values,
       CAST(min(len("values")) AS BIGINT) AS min_dimension, CAST(max(len("values")) AS BIGINT) AS max_dimension,
       true AS has_sparse_column, count(sparse_indices) AS with_sparse, count(metadata) AS with_metadata
FROM raw""",

    "dimension_histogram": f"""
WITH {RAW} SELECT CAST(coalesce(len("values"), -1) AS BIGINT) AS dimension, count(*) AS n_rows FROM raw GROUP BY 1""",

    "record_check": f"""
WITH {RAW}
SELECT namespace, id, CAST(coalesce(len("values"), -1) AS BIGINT) AS dimension,
       sparse_indices IS NOT NULL AS has_sparse, reasons
FROM checked""",

    "record_preview": f"""
WITH {VECTORS}
SELECT namespace, id, '[' || "values"[1]::VARCHAR || ', ' || "values"[2]::VARCHAR || ', ' || "values"[3]::VARCHAR
       || ', ... ] (' || len("values") || ' elements)' AS "values"
FROM vectors""",

    "text_preview": f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id,
       CASE WHEN length(text) > {M.PREVIEW_TEXT} THEN substring(text, 1, {M.PREVIEW_TEXT}) || '...' ELSE text END AS text,
       lang
FROM documents""",

    "import_layout_check": """
SELECT DISTINCT 'ns-' || label AS namespace, 'PASS' AS verdict, true AS accepted FROM embeddings""",

    "import_accepted": f"""
WITH {RAW}, accepted AS (
  SELECT DISTINCT namespace, id, "values", array_to_string(sparse_indices, ',') AS sparse_indices, metadata
  FROM checked WHERE reasons = '')
{flat('SELECT * FROM accepted', 'namespace, id, metadata, sparse_indices')}""",

    "import_rejected": f"""
WITH {RAW}
SELECT namespace, id, CASE WHEN reasons = '' THEN 'repeated_id' ELSE reasons END AS reasons
FROM checked WHERE reasons <> '' OR copy = 2""",

    "import_aborted": f"""
WITH {RAW}, found AS (SELECT count(*) > 0 AS aborted FROM checked WHERE reasons <> '' OR copy = 2)
SELECT 0::BIGINT AS files, aborted, 0::BIGINT AS version FROM found WHERE aborted""",

    "import_jobs": f"""
WITH {RAW}, good AS (SELECT count(*) AS n FROM (SELECT DISTINCT namespace, id FROM checked WHERE reasons = '')),
bad AS (SELECT count(*) > 0 AS any_bad FROM checked WHERE reasons <> '' OR copy = 2),
jobs AS (
  SELECT 'all-abort' AS job_id, any_bad AS failed, n FROM good, bad
  UNION ALL SELECT 'all-continue', false, n FROM good UNION ALL SELECT 'sound-abort', false, n FROM good)
SELECT job_id, CASE WHEN failed THEN 'Failed' ELSE 'Completed' END AS status, true AS done,
       CASE WHEN failed THEN '0.0%' ELSE '100.0%' END AS progress, CASE WHEN failed THEN 0 ELSE n END AS records_imported,
       failed AS has_error, true AS has_times
FROM jobs""",

    "upsert_result": UPSERTED,
    "upsert_plan": UPSERTED,

    "upsert_batches": f"""
SELECT vec_id // {M.BATCH_SIZE} AS batch, count(*) AS n_rows,
       count(*) FILTER (vec_id % 310 = 7 OR vec_id % 470 = 21) AS n_bad,
       count(*) FILTER (vec_id % 310 = 7 OR vec_id % 470 = 21) = 0 AS success
FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS vec_id FROM embeddings) GROUP BY 1""",

    "upsert_batches_result": f"""
WITH placed AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS position FROM embeddings),
bad AS (SELECT DISTINCT position // {M.BATCH_SIZE} AS batch FROM placed
        WHERE position % 310 = 7 OR position % 470 = 21)
SELECT CASE WHEN label = 0 THEN '' ELSE 'ns-' || label END AS namespace, CAST(vec_id AS VARCHAR) AS id
FROM placed WHERE position // {M.BATCH_SIZE} NOT IN (SELECT batch FROM bad)""",

    "delete_namespace_result": f"""
WITH {VECTORS} {stats("SELECT * FROM vectors WHERE namespace NOT IN ('', 'ns-4')")}""",

    "delete_all_result": """
SELECT 1::BIGINT AS version, count(*) AS vector_count FROM embeddings UNION ALL SELECT 2::BIGINT, 0::BIGINT""",

    "delete_default_result": """
SELECT count(*) AS before, count(*) FILTER (label <> 0) AS after FROM embeddings""",

    "backup_manifest": """
SELECT 'nightly' AS name, 'Backup of vectors' AS description, 'Ready' AS status, 'vectors' AS source_index_name,
       count(*) AS record_count, 'aws' AS cloud, 'us-east-1' AS region, count(*) > 0 AS has_size
FROM embeddings""",

    "backup_names": "SELECT event_id, 'vectors-backup-' || strftime(ts, '%Y%m%d-%H%M%S') AS name FROM events",

    "backup_rows": f"""
WITH {VECTORS}, copied AS (SELECT *, '{{"batch_id": ' || (number // 100) || '}}' AS metadata FROM vectors)
{flat('SELECT * FROM copied', 'namespace, id, metadata')}""",

    "layout_classes": f"WITH {MANIFEST} SELECT * FROM named",

    "layout_verdict": f"""
WITH {MANIFEST}, counts AS (
  SELECT count(*) AS objects, count(*) FILTER (class = 'valid') AS valid,
         count(*) FILTER (class = 'bad_structure') AS bad_structure,
         count(*) FILTER (class = 'ignored') AS ignored, count(*) FILTER (class = 'skipped') AS skipped
  FROM named),
judged AS (SELECT *, CASE WHEN valid = 0 THEN 'FAIL' WHEN bad_structure > 0 THEN 'WARN' ELSE 'PASS' END AS verdict
           FROM counts)
SELECT *, verdict <> 'FAIL' AS accepted FROM judged""",

    "layout_totals": f"""
WITH {MANIFEST}
SELECT namespace, grouping(namespace) = 1 AS is_total, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes,
       round(CAST(sum(size) AS DOUBLE) / {M.BYTES_PER_MB}, 6) AS size_mb
FROM named WHERE class = 'valid' GROUP BY ROLLUP (namespace)""",

    "layout_first_files": f"""
WITH {MANIFEST}, placed AS (
  SELECT class, namespace, key, size, row_number() OVER (PARTITION BY class, namespace ORDER BY key) AS position,
         count(*) OVER (PARTITION BY class, namespace) AS files,
         CASE WHEN class = 'valid' THEN {M.FILES_PER_NAMESPACE} ELSE {M.BAD_PATHS} END AS shown
  FROM named WHERE class IN ('valid', 'bad_structure'))
SELECT class, namespace, position, key, size, CAST(greatest(files - shown, 0) AS BIGINT) AS more
FROM placed WHERE position <= shown""",

    "uri_split": f"""
WITH {REQUESTS}, trimmed AS (SELECT *, rtrim(uri, '/') AS u FROM requests)
SELECT request_id, uri, {uri_part(1)} AS bucket, {uri_part(2)} AS prefix FROM trimmed""",

    "uri_compatibility": f"""
WITH {REQUESTS}, kinds AS (
  SELECT *, starts_with(uri, 's3://') AS s3, starts_with(uri, 'gs://') AS gcs,
         contains(uri, '.blob.core.windows.net/') AS blob FROM requests)
SELECT request_id, env,
       CASE WHEN s3 THEN 's3' WHEN gcs THEN 'gcs' WHEN blob THEN 'azure' ELSE 'skip' END AS storage,
       CASE env WHEN 'byoc-aws' THEN s3 WHEN 'saas' THEN s3 OR gcs OR blob ELSE gcs OR blob END AS compatible,
       CASE WHEN starts_with(lower(trim(error_mode)), 'a') THEN 'ABORT' ELSE 'CONTINUE' END AS error_mode
FROM kinds""",

    "latency_summary": f"WITH {LOG}, g AS (SELECT {LATENCY} FROM op_log) SELECT {SUMMARY} FROM g",

    "latency_by_run": f"""
WITH {LOG}, g AS (SELECT run_id, {LATENCY} FROM op_log GROUP BY run_id) SELECT run_id, {SUMMARY} FROM g""",

    "latency_by_namespace": f"""
WITH {BY_NAMESPACE}
SELECT namespace, queries, errors, round(avg_ms, 6) AS avg_ms, round(p50_ms, 6) AS p50_ms FROM by_namespace""",

    "hot_namespaces": f"""
WITH {BY_NAMESPACE}, top AS (SELECT * FROM by_namespace ORDER BY queries DESC, namespace LIMIT {M.HOT_NAMESPACES})
SELECT CASE WHEN namespace = '' THEN '(default)' ELSE namespace END AS namespace, queries, errors,
       round(avg_ms, 6) AS avg_ms, round(p50_ms, 6) AS p50_ms,
       (SELECT greatest(count(*) - {M.HOT_NAMESPACES}, 0) FROM by_namespace) AS others
FROM top""",

    "latency_extremes": f"""
WITH {BY_NAMESPACE}, labelled AS (
  SELECT CASE WHEN namespace = '' THEN '(default)' ELSE namespace END AS label, namespace, queries,
         round(avg_ms, 2) AS mean FROM by_namespace),
fast AS (SELECT * FROM labelled ORDER BY mean, queries DESC, namespace LIMIT 1),
slow AS (SELECT * FROM labelled ORDER BY mean DESC, queries DESC, namespace LIMIT 1)
SELECT fast.label AS fastest, fast.mean AS fastest_avg_ms, slow.label AS slowest, slow.mean AS slowest_avg_ms
FROM fast, slow""",

    "write_throughput": f"""
WITH {LOG}, g AS (
  SELECT run_id, CAST(coalesce(sum(n_rows) FILTER (success), 0) AS BIGINT) AS rows_written,
         count(*) FILTER (success) AS batches, count(*) FILTER (NOT success) AS errors,
         (max(us) - min(us)) / 1e6::DOUBLE AS elapsed
  FROM op_log GROUP BY run_id)
SELECT run_id, rows_written, batches, errors, round(elapsed, 6) AS elapsed_sec,
       round(CASE WHEN elapsed > 0 THEN rows_written / elapsed END, 6) AS rows_per_sec,
       round(CASE WHEN elapsed > 0 THEN batches / elapsed END, 6) AS batches_per_sec
FROM g""",

    "throughput_ticks": f"""
WITH {LOG}, runs AS (
  SELECT run_id, min(us) AS start_us, (max(us) - min(us)) // 1000000 AS seconds FROM op_log GROUP BY run_id),
spine AS (
  SELECT run_id, seconds, unnest(generate_series(0, seconds // {TICK_SECONDS})) AS tick FROM runs),
counts AS (
  SELECT run_id, (us - start_us) // {1_000_000 * TICK_SECONDS} AS tick,
         count(*) FILTER (success) AS ok, count(*) FILTER (NOT success) AS bad
  FROM op_log JOIN runs USING (run_id) GROUP BY 1, 2)
SELECT run_id, tick, seconds - tick * {TICK_SECONDS} AS remaining_sec,
       CAST(sum(coalesce(ok, 0)) OVER w AS BIGINT) AS total_queries, coalesce(ok, 0) AS queries,
       CAST(sum(coalesce(bad, 0)) OVER w AS BIGINT) AS total_errors
FROM spine LEFT JOIN counts USING (run_id, tick)
WINDOW w AS (PARTITION BY run_id ORDER BY tick)""",

    "throughput_each_second": f"""
WITH {LOG}, runs AS (
  SELECT run_id, min(us) AS start_us, (max(us) - min(us)) // 1000000 AS seconds FROM op_log GROUP BY run_id),
counts AS (
  SELECT run_id, (us - start_us) // 1000000 AS tick, count(*) FILTER (success) AS ok,
         count(*) FILTER (NOT success) AS bad
  FROM op_log JOIN runs USING (run_id) GROUP BY 1, 2)
SELECT run_id, seconds + 1 AS ticks, seconds + 1 - count(*) FILTER (ok > 0) AS quiet,
       CAST(sum(ok) AS BIGINT) AS queries, CAST(sum(bad) AS BIGINT) AS errors,
       CAST(sum(ok * (seconds - tick + 1)) AS BIGINT) AS sum_of_totals,
       CAST(sum(bad * (seconds - tick + 1)) AS BIGINT) AS sum_of_errors
FROM counts JOIN runs USING (run_id) GROUP BY run_id, seconds""",

    "status_changes": STATUS_CHANGES,

    "record_changes": f"""
WITH {EVENTS}
SELECT job_id, seq, elapsed, status, uri, percent_complete, coalesce(records_imported, -1) AS records_imported, error
FROM watched
WHERE place = 1 OR status IS DISTINCT FROM p_status OR uri IS DISTINCT FROM p_uri
   OR percent_complete IS DISTINCT FROM p_percent OR records_imported IS DISTINCT FROM p_records
   OR error IS DISTINCT FROM p_error""",

    "job_outcomes": f"WITH {OUTCOMES} SELECT * FROM outcomes",

    "job_history": f"""
WITH {OUTCOMES}
SELECT job_id, status, uri, progress, records_imported, created_us, finished_us, error,
       row_number() OVER (ORDER BY created_us DESC, job_id DESC) - 1 AS position
FROM outcomes""",

    "synthetic_vectors": f"""
WITH made AS (
  SELECT 'vec-' || doc_id AS id, {uniform('doc_id', M.VECTOR_DIMENSION, 0)} AS "values",
         '{{"batch_id": ' || (doc_id // {M.BATCH_SIZE}) || '}}' AS metadata
  FROM documents)
{flat('SELECT * FROM made', 'id, metadata')}""",

    "synthetic_queries": f"""
WITH made AS (SELECT doc_id AS qid, {uniform('doc_id', DIMENSION, 1)} AS qv FROM documents)
{flat('SELECT * FROM made', 'qid', 'qv')}""",

    "constant_record": f"""
WITH {VECTORS}, made AS (
  SELECT DISTINCT namespace, 'test-vector-1' AS id,
         list_transform(range({M.VECTOR_DIMENSION}), lambda x: 0.1::DOUBLE) AS "values",
         '{{"description": "Test vector for demonstration"}}' AS metadata
  FROM vectors)
{flat('SELECT * FROM made', 'namespace, id, metadata')}""",

    "write_batches": f"WITH {BATCHES} SELECT number, position, position // {M.BATCH_SIZE} AS batch FROM placed",

    "write_batch_sizes": f"""
WITH {BATCHES} SELECT position // {M.BATCH_SIZE} AS batch, count(*) AS n_rows FROM placed GROUP BY 1""",

    "stream_ticks": f"""
WITH {LOG}
SELECT us // 1000000 AS window_sec, namespace, count(*) FILTER (success) AS queries,
       count(*) FILTER (NOT success) AS errors
FROM op_log GROUP BY 1, 2""",

    "stream_ticks_global": f"""
WITH {LOG}
SELECT us // 1000000 AS window_sec, count(*) FILTER (success) AS queries, count(*) FILTER (NOT success) AS errors
FROM op_log GROUP BY 1""",

    "stream_status_changes": STATUS_CHANGES,
    "stream_backup_changes": STATUS_CHANGES.replace("'Completed'", "'Ready'"),
    "stream_upsert": UPSERTED,
}
