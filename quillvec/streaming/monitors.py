"""Streaming forms: throughput per second, job monitors, continuous upsert."""

from __future__ import annotations

import datetime as dt
import logging
import time

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from quillvec import model as M
from quillvec.functions.scalars import micros
from quillvec.operators import jobs
from quillvec.operators.collection import Collection, CommitConflict
from quillvec.streaming.job_state import JobMonitor

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGE_SCHEMA = "job_id string, seq bigint, status string, elapsed bigint"


def live_throughput(log: DataFrame, per_namespace: bool = True, tick: str = "1 second",
                    delay: str = "10 seconds") -> DataFrame:
    """Successes and errors per tumbling window, in append mode: a window is given out once it is closed.

    Totals of all namespaces are added up from theirs by a second aggregate on the windows, so a window with very many
    rows is shared out first. Quiet windows give no row; ``throughput_ticks`` fills them in when the output is read
    as a batch. Windows not yet closed when a stream ends come from ``last_throughput``.
    """
    counts = _counts(log.withWatermark("ts", delay), tick)
    if not per_namespace:
        counts = counts.groupBy(F.window("w", tick).alias("w")).agg(
            F.sum("queries").alias("queries"), F.sum("errors").alias("errors"))
    return _windows(counts, per_namespace)


def last_throughput(log: DataFrame, per_namespace: bool = True, tick: str = "1 second",
                    delay: str = "10 seconds") -> DataFrame:
    """The windows that ``live_throughput`` holds back after the last row of ``log``: those not over for ``delay``.

    Together with what the stream gave out they are all windows of the log, each once.
    """
    # A watermark has milliseconds, and closes the windows that end at it.
    closed = log.agg(F.date_trunc("millisecond", F.max("ts") - F.expr(f"INTERVAL {delay}")).alias("closed"))
    counts = _counts(log.join(F.broadcast(closed), F.col("ts") >= F.col("closed") - F.expr(f"INTERVAL {tick}")), tick, "closed") \
        .filter("w.end > closed").drop("closed")
    if not per_namespace:
        counts = counts.groupBy("w").agg(F.sum("queries").alias("queries"), F.sum("errors").alias("errors"))
    return _windows(counts, per_namespace)


def _counts(log: DataFrame, tick: str, *also: str) -> DataFrame:
    return log.groupBy(F.window("ts", tick).alias("w"), "namespace", *also).agg(
        F.count_if("success").alias("queries"), F.count_if(~F.col("success")).alias("errors"))


def _windows(counts: DataFrame, per_namespace: bool) -> DataFrame:
    return counts.select(F.col("w.start").alias("window_start"), *(["namespace"] if per_namespace else []), "queries",
                         "errors")


def status_monitor(events: DataFrame, terminal: tuple[str, ...] = M.IMPORT_TERMINAL, delay: str = "10 seconds",
                   forget_seconds: int | None = None) -> DataFrame:
    """Reported states of each job until its first terminal one. Needs the RocksDB state store, see ``with_rocksdb``.

    Events are taken in the order of ``ts, seq`` whatever micro-batch they come in, if it is within ``delay`` of the newest;
    later ones are dropped. A state is given out once the watermark has passed it, and those not passed when a stream
    ends come from ``last_changes``. Of a job that is done one flag stays, so that events after the end are known for what
    they are; with ``forget_seconds`` it goes that long after the end. An event without a time is dropped. The size
    of a batch, which the log readers bound, also bounds what one job can bring to its task at a time.
    """
    forget = None if forget_seconds is None else forget_seconds * 1000
    # A watermark needs a timestamp with a zone, and state times are those of the column's own clock.
    timed = events.filter("ts IS NOT NULL").select(
        "job_id", micros(F.col("ts")).alias("us"), "seq", "status") \
        .withColumn("at", F.timestamp_micros("us")).withWatermark("at", delay)
    return timed.groupBy("job_id").transformWithState(
        JobMonitor(terminal, M.REPRINT_SECONDS, forget), CHANGE_SCHEMA, "Append", "EventTime")


def with_rocksdb(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` whose streams keep their state in RocksDB; ``spark`` itself stays as it is."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            session.conf.set(name, value)
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return session


def last_changes(events: DataFrame, terminal: tuple[str, ...] = M.IMPORT_TERMINAL, delay: str = "10 seconds") -> DataFrame:
    """The states that ``status_monitor`` holds back after the last row of ``events``: those later than ``delay`` before it.

    Together with what the stream gave out they are all of ``jobs.status_changes``, each once. Only jobs with such events
    are looked at. ``seq`` tells the events of a job apart.
    """
    events, us = events.filter("ts IS NOT NULL"), micros(F.col("ts"))
    # A watermark has milliseconds, and gives out the events that it reaches.
    millis = F.expr(f"unix_millis(timestamp_millis(0) + INTERVAL {delay})")
    closed = events.agg(((F.floor(F.max(us) / 1000) - millis) * 1000).alias("closed"))
    late = events.join(F.broadcast(closed), us > F.col("closed")).select("job_id", "seq")
    known = events.join(late, "job_id", "left_semi")
    changes = jobs.status_changes(known, lambda status: F.coalesce(status.isin(*terminal), F.lit(False)))
    return changes.join(late, ["job_id", "seq"], "left_semi")


def continuous_upsert(changes: DataFrame, collection: Collection, name: str,
                      op_log: str | None = None) -> DataStreamWriter:
    """Apply each micro-batch to a collection as one version; a batch replayed after a failure is skipped.

    Records keep their ``seq``, so the result doesn't depend on how the stream is cut into batches, nor on the order in
    which changes arrive. With ``op_log``, each batch leaves one row in an operation log there, also if it runs more
    than once, and a batch that cannot be applied counts as an error with no rows while later batches go on.
    Without it, such a batch stops the stream. The log belongs to one stream.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        if op_log is None:
            collection.upsert(batch, stream=name, batch=batch_id)
            return
        begin, rows, success = time.time(), 0, True
        try:
            collection.upsert(batch, stream=name, batch=batch_id)
            rows = batch.count()
        except (PySparkException, Py4JJavaError, CommitConflict) as err:
            logging.getLogger(__name__).warning("batch %s of %s failed: %s", batch_id, name, err)
            success = False
        row = (name, batch_id, dt.datetime.fromtimestamp(begin), "upsert", None, rows, success,
               (time.time() - begin) * 1000 if success else 0.0)
        # A folder for each batch, so that a batch that runs again replaces its row.
        collection.spark.createDataFrame([row], M.OP_LOG_SCHEMA).coalesce(1).write.mode("overwrite") \
            .parquet(f"{op_log}/batch={batch_id}")

    return changes.writeStream.foreachBatch(apply)
