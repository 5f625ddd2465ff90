"""Named queries: every operator on whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillvec import model as M
from quillvec.functions import scalars, uris
from quillvec.functions.records import reject_reasons
from quillvec.operators import backup, collection, generate, ingest, jobs, layout, metrics, search
from quillvec.operators.collection import Collection
from quillvec.plans import views as V
from quillvec.plans.shipping import ship_package
from quillvec.sources.logs import BYTES_PER_BATCH, read_status_events
from quillvec.sources.manifest import EmptyListing, list_directory
from quillvec.storage import checkpointed, new_dir
from quillvec.streaming import monitors

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DIGITS = 6
TICK_SECONDS = 60
# Parts in which status events arrive; none of the given tables spans more than 31 days, so none is later than a week.
SLICES, LATE_DAYS = 5, 7


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf.rstrip("/"))

    QUERIES[fn.__name__] = run
    return run


def rounded(df: DataFrame) -> DataFrame:
    """Computed doubles at six digits, so that sums taken in another order compare equal."""
    return df.select(*[F.round(f.name, DIGITS).alias(f.name) if f.dataType.typeName() == "double" else f.name
                       for f in df.schema])


def whole(df: DataFrame, *columns: str) -> DataFrame:
    """Whole numbers with -1 for NULL, as clients without nullable integers would turn them into fractions."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(-1)) for c in columns})


def flat(df: DataFrame, vector: str = "values") -> DataFrame:
    """A vector column as plain numbers: length, ends, and a sum weighted by position. Any client can compare
    these, which is not so for arrays."""
    weighted = f"aggregate(transform({vector}, (x, i) -> x * (i + 1)), 0D, (a, x) -> a + x)"
    return df.selectExpr(
        *[c for c in df.columns if c != vector], f"bigint(size({vector})) AS dimension",
        f"{vector}[0] AS first_value", f"element_at({vector}, -1) AS last_value",
        f"round({weighted}, {DIGITS}) AS weighted")


# -- search -------------------------------------------------------------------------------------------------------

@query
def topk_all_namespaces(spark, sf):
    """Every vector as a query, the ten best of each namespace by inner product."""
    return rounded(search.search(V.search_vectors(spark, sf), V.queries(spark, sf)))


@query
def topk_routed(spark, sf):
    """Each query in its own namespace with its own number of results; some are too long, too short, NULL or not numbers."""
    odd = ("CASE qid % 7 WHEN 1 THEN concat(qv, array(float(1))) WHEN 2 THEN slice(qv, 2, size(qv)) "
           "WHEN 3 THEN NULL WHEN 4 THEN transform(qv, x -> float('NaN')) ELSE qv END AS qv")
    routed = V.queries(spark, sf).selectExpr(
        "qid", odd, "concat('ns-', qid % 9 + 1) AS namespace", "int(qid % 4 + 1) AS top_k")
    return rounded(search.search_routed(V.search_vectors(spark, sf), routed))


@query
def topk_one_namespace(spark, sf):
    return rounded(search.search_namespace(V.search_vectors(spark, sf), V.queries(spark, sf), "ns-3", metric="cosine")) \
        .drop("namespace")


@query
def topk_default_namespace(spark, sf):
    """One synthetic query vector on the default namespace, by distance."""
    q = generate.uniform_block([0], V.DIMENSION, 1)[0] / 8
    return rounded(search.top_k(V.search_vectors(spark, sf), q.tolist(), metric="euclidean"))


# -- collection ---------------------------------------------------------------------------------------------------

@query
def collection_stats(spark, sf):
    return collection.collection_stats(V.vectors(spark, sf))


@query
def vector_profile(spark, sf):
    return ingest.vector_profile(V.raw_records(spark, sf))


@query
def dimension_histogram(spark, sf):
    return whole(ingest.dimension_histogram(V.raw_records(spark, sf)), "dimension")


@query
def record_check(spark, sf):
    return whole(ingest.check_records(V.raw_records(spark, sf), V.DIMENSION), "dimension")


@query
def record_preview(spark, sf):
    return ingest.preview(V.vectors(spark, sf))


@query
def text_preview(spark, sf):
    return ingest.preview(V.table(spark, sf, "documents").select("doc_id", "text", "lang"))


def _loaded(spark, sf):
    prefix = new_dir(spark, "layout")
    V.write_import_layout(V.raw_records(spark, sf), prefix)
    target = Collection(spark, new_dir(spark, "collection"))
    return target, ingest.import_vectors(target, prefix, V.DIMENSION)


@query
def import_layout_check(spark, sf):
    """The verdict on a directory as it lies there, and its namespaces."""
    prefix = new_dir(spark, "layout")
    V.write_import_layout(V.raw_records(spark, sf), prefix)
    classes = checkpointed(layout.classify(list_directory(spark, prefix), ""))
    found = classes.filter("class = 'valid'").select("namespace").distinct()
    return found.select("namespace", *[layout.verdict(classes).select(c).scalar().alias(c)
                                       for c in ("verdict", "accepted")])


@query
def import_accepted(spark, sf):
    target, _ = _loaded(spark, sf)
    return flat(target.read().selectExpr("namespace", "id", "values", "metadata",
                                         "array_join(sparse_values.indices, ',') AS sparse_indices"))


@query
def import_rejected(spark, sf):
    target, result = _loaded(spark, sf)
    return ingest.rejects(target, result).select("namespace", "id", F.array_join("reasons", ",").alias("reasons"))


@query
def import_aborted(spark, sf):
    """What an import of the faulty records leaves behind in ABORT mode: the version, and files on disk."""
    prefix, root = new_dir(spark, "layout"), new_dir(spark, "collection")
    V.write_import_layout(V.raw_records(spark, sf), prefix)
    target = Collection(spark, root)
    try:
        ingest.import_vectors(target, prefix, V.DIMENSION, M.ABORT)
        aborted = False
    except ingest.ImportAborted:
        aborted = True
    try:
        found = list_directory(spark, root)
    except EmptyListing:
        found = spark.createDataFrame([], M.MANIFEST_SCHEMA)
    return found.agg(F.count("*").alias("files")).select(
        "files", F.lit(aborted).alias("aborted"), F.lit(target.version().number).cast("long").alias("version"))


@query
def import_jobs(spark, sf):
    """Job records of three imports: all records in either mode, and in ABORT mode those of them that are sound."""
    log, raw = new_dir(spark, "jobs"), V.raw_records(spark, sf)
    faulty, sound = new_dir(spark, "layout"), new_dir(spark, "layout")
    V.write_import_layout(raw, faulty)
    V.write_import_layout(raw.filter(F.size(reject_reasons(V.DIMENSION)) == 0).dropDuplicates(["namespace", "id"]), sound)
    for job_id, prefix, mode in (("all-abort", faulty, M.ABORT), ("all-continue", faulty, M.CONTINUE),
                                 ("sound-abort", sound, M.ABORT)):
        try:
            ingest.import_vectors(Collection(spark, new_dir(spark, "collection")), prefix, V.DIMENSION, mode, log, job_id)
        except ingest.ImportAborted:
            pass  # the job record tells
    return jobs.job_outcomes(read_status_events(spark, log)).select(
        "job_id", "status", "done", "progress", "records_imported", F.col("error").isNotNull().alias("has_error"),
        (F.col("finished_us") >= F.col("created_us")).alias("has_times"))


def _stored(spark, sf):
    target = Collection(spark, new_dir(spark, "collection"))
    target.upsert(V.records(spark, sf).drop("number").withColumn("seq", F.lit(0).cast("long")))
    return target


@query
def upsert_result(spark, sf):
    """A collection written by one upsert and changed by others, the newest changes first."""
    target = _stored(spark, sf)
    changes = V.changes(spark, sf)
    target.upsert(changes.filter("seq = 2"))
    target.upsert(changes.filter("seq = 1"))
    return flat(target.read().select("namespace", "id", "values"))


def _in_batches(spark, sf):
    target = Collection(spark, new_dir(spark, "collection"))
    return target, target.upsert_batches(V.partly_faulty(spark, sf), "number", seq="number", dimension=V.DIMENSION)


@query
def upsert_batches(spark, sf):
    """Batches of 100 records, each refused as a whole if one of its records is bad."""
    return _in_batches(spark, sf)[1][1]


@query
def upsert_batches_result(spark, sf):
    """What is stored of batches without bad records."""
    return _in_batches(spark, sf)[0].read().select("namespace", "id")


@query
def upsert_plan(spark, sf):
    """The same changes as a plain table operation."""
    return flat(collection.upserted(V.vectors(spark, sf).withColumn("metadata", F.lit(None).cast("string")),
                                    V.changes(spark, sf)).select("namespace", "id", "values"))


@query
def delete_namespace_result(spark, sf):
    target = _stored(spark, sf)
    target.delete_namespace("ns-4")
    target.delete_namespace()
    return collection.collection_stats(target.read())


@query
def delete_all_result(spark, sf):
    """Statistics of every version while all namespaces are dropped: stored, then empty."""
    target = _stored(spark, sf)
    target.delete_all()
    before = collection.collection_stats(target.read(number=1)).filter("is_total").select("vector_count")
    after = target.read().agg(F.count("*").alias("vector_count"))
    return before.withColumn("version", F.lit(1)).unionByName(after.withColumn("version", F.lit(2))) \
        .select(F.col("version").cast("long").alias("version"), "vector_count")


@query
def delete_default_result(spark, sf):
    """Records before and after the default namespace is dropped, as the operator reports them."""
    before, after = _stored(spark, sf).delete_default_counted()
    return spark.createDataFrame([(before, after)], "before long, after long")


@query
def backup_manifest(spark, sf):
    root = new_dir(spark, "backups")
    target = _stored(spark, sf)
    backup.create_backup(target, root, "vectors", name="nightly", cloud="aws", region="us-east-1")
    return backup.list_backups(spark, root).select(
        "name", "description", "status", "source_index_name", "record_count", "cloud", "region",
        (F.col("size_bytes") > 0).alias("has_size"))


@query
def backup_rows(spark, sf):
    """Rows of a snapshot taken before a delete."""
    root = new_dir(spark, "backups")
    target = _stored(spark, sf)
    backup_id = backup.create_backup(target, root, "vectors")
    target.delete_all()
    return flat(backup.read_backup(target, root, backup_id).select("namespace", "id", "values", "metadata"))


@query
def backup_names(spark, sf):
    """The name that a backup taken at the time of each event would get."""
    return V.events(spark, sf).select("event_id", scalars.backup_name(F.lit("vectors"), F.col("ts")).alias("name"))


# -- layout and requests ------------------------------------------------------------------------------------------

def _classes(spark, sf):
    return layout.classify(V.manifest(spark, sf), V.PREFIX)


@query
def layout_classes(spark, sf):
    return _classes(spark, sf)


@query
def layout_verdict(spark, sf):
    return layout.verdict(_classes(spark, sf))


@query
def layout_totals(spark, sf):
    return rounded(layout.totals(_classes(spark, sf)))


@query
def layout_first_files(spark, sf):
    return layout.first_files(_classes(spark, sf))


@query
def uri_split(spark, sf):
    bucket, prefix = uris.split_uri(F.col("uri"))
    return V.import_requests(spark, sf).select("request_id", "uri", bucket.alias("bucket"), prefix.alias("prefix"))


@query
def uri_compatibility(spark, sf):
    uri = F.col("uri")
    return V.import_requests(spark, sf).select(
        "request_id", "env", uris.storage_kind(uri).alias("storage"),
        uris.is_compatible(F.col("env"), uri).alias("compatible"),
        scalars.error_mode(F.col("error_mode")).alias("error_mode"))


# -- operation logs -----------------------------------------------------------------------------------------------

def _log(spark, sf):
    return V.op_log(V.events(spark, sf))


@query
def latency_summary(spark, sf):
    """One summary of the whole log."""
    return rounded(metrics.latency_summary(_log(spark, sf)))


@query
def latency_by_run(spark, sf):
    log = _log(spark, sf)
    return rounded(metrics.latency_summary(log, ["run_id"], metrics.run_times(log)))


@query
def latency_by_namespace(spark, sf):
    return rounded(metrics.latency_by_namespace(_log(spark, sf)))


@query
def hot_namespaces(spark, sf):
    return rounded(metrics.hot_namespaces(metrics.latency_by_namespace(_log(spark, sf))))


@query
def latency_extremes(spark, sf):
    return metrics.latency_extremes(metrics.latency_by_namespace(_log(spark, sf)))


@query
def write_throughput(spark, sf):
    return rounded(metrics.write_throughput(_log(spark, sf)))


@query
def throughput_ticks(spark, sf):
    return metrics.throughput_ticks(_log(spark, sf), tick_seconds=TICK_SECONDS)


@query
def throughput_each_second(spark, sf):
    """All ticks of one second, summed up for each run."""
    ticks = metrics.throughput_ticks(_log(spark, sf), tick_seconds=1)
    return ticks.groupBy("run_id").agg(
        F.count("*").alias("ticks"), F.sum("queries").alias("queries"), F.sum("total_queries").alias("sum_of_totals"),
        F.max("total_errors").alias("errors"), F.sum("total_errors").alias("sum_of_errors"),
        F.count_if(F.col("queries") == 0).alias("quiet"))


# -- jobs ---------------------------------------------------------------------------------------------------------

def _events(spark, sf):
    return V.status_events(V.events(spark, sf))


@query
def status_changes(spark, sf):
    return jobs.status_changes(_events(spark, sf))


@query
def record_changes(spark, sf):
    return whole(rounded(jobs.record_changes(_events(spark, sf))), "records_imported")


@query
def job_outcomes(spark, sf):
    return whole(jobs.job_outcomes(_events(spark, sf)), "finished_us")


@query
def job_history(spark, sf):
    return whole(jobs.job_history(jobs.job_outcomes(_events(spark, sf))), "finished_us")


# -- generators ---------------------------------------------------------------------------------------------------

@query
def synthetic_vectors(spark, sf):
    return flat(generate.synthetic_vectors(V.numbered(spark, sf)))


@query
def synthetic_queries(spark, sf):
    return flat(generate.query_vectors(V.numbered(spark, sf), V.DIMENSION), "qv")


@query
def constant_record(spark, sf):
    """One test record for each namespace of the collection."""
    return flat(generate.constant_records(V.vectors(spark, sf).select("namespace").distinct()))


@query
def write_batches(spark, sf):
    return generate.write_batches(V.numbered(spark, sf), "number")


@query
def write_batch_sizes(spark, sf):
    return generate.batch_sizes(generate.write_batches(V.numbered(spark, sf), "number"))


# -- streams: run over all input present, then read what they wrote ------------------------------------------------

def _event_stream(spark, sf):
    schema = V.events(spark, sf).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet") \
        .option("maxBytesPerTrigger", BYTES_PER_BATCH).parquet(sf)


def _finish(writer, spark, name: str) -> None:
    stream = writer.option("checkpointLocation", new_dir(spark, f"{name}-state")).trigger(availableNow=True).start()
    stream.awaitTermination()


def _ticks(spark, sf, per_namespace: bool) -> DataFrame:
    """Windows that the stream gives out, and those it holds back until later rows come."""
    events = _event_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    out = new_dir(spark, "ticks")
    ticks = monitors.live_throughput(V.op_log(events), per_namespace)
    _finish(ticks.writeStream.format("parquet").option("path", out).outputMode("append"), spark, "ticks")
    log = V.op_log(V.events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")))
    whole = spark.read.schema(ticks.schema).parquet(out).unionByName(monitors.last_throughput(log, per_namespace))
    return whole.select(scalars.whole_seconds(scalars.micros(F.col("window_start"))).alias("window_sec"),
                        *[c for c in ticks.columns if c != "window_start"])


@query
def stream_ticks(spark, sf):
    """Operations of each namespace by second."""
    return _ticks(spark, sf, True)


@query
def stream_ticks_global(spark, sf):
    """Operations by second, added up from those of the namespaces."""
    return _ticks(spark, sf, False)


def _changes(spark, sf, view, terminal) -> DataFrame:
    """Events in five parts, each with some that are older than others of the part before, and a run of the stream for
    each part; then the states that the stream holds back until later events come."""
    source, out, state = (new_dir(spark, name) for name in ("events", "changes", "changes-state"))
    delay = f"{LATE_DAYS} days"
    for part in V.arrivals(spark, sf, SLICES):
        part.write.mode("append").parquet(source)
        events = monitors.with_rocksdb(spark).readStream.schema(part.schema) \
            .option("maxBytesPerTrigger", BYTES_PER_BATCH).parquet(source)
        found = monitors.status_monitor(view(events), terminal, delay)
        found.writeStream.format("parquet").option("path", out).option("checkpointLocation", state) \
            .outputMode("append").trigger(availableNow=True).start().awaitTermination()
    last = monitors.last_changes(view(V.events(spark, sf)), terminal, delay)
    return spark.read.schema(found.schema).parquet(out).unionByName(last)


@query
def stream_status_changes(spark, sf):
    return _changes(spark, sf, V.status_events, M.IMPORT_TERMINAL)


@query
def stream_backup_changes(spark, sf):
    """The monitor of backups, with their own terminal states."""
    return _changes(spark, sf, V.backup_events, M.BACKUP_TERMINAL)


@query
def stream_upsert(spark, sf):
    """Changes in five micro-batches, mixed so that older ones come after newer ones."""
    source = new_dir(spark, "changes")
    V.changes(spark, sf).repartitionByRange(5, F.xxhash64("id", "seq")).write.parquet(source)
    target = _stored(spark, sf)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)
    _finish(monitors.continuous_upsert(stream, target, "changes"), spark, "upsert")
    return flat(target.read().select("namespace", "id", "values"))
