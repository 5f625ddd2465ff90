"""Analytics of operation logs: latency summaries, throughput, hot and slow namespaces, ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillvec import model as M
from quillvec.functions.ranks import MEDIAN, SORT_ROWS, coarse_bucket, first_brackets, fraction, resolve
from quillvec.functions.scalars import micros, namespace_label
from quillvec.storage import checkpointed, sized

TICKS_PER_CHUNK = 3600


def run_times(log: DataFrame) -> DataFrame:
    """Runs as the log shows them, for logs that come without a table of runs."""
    return log.groupBy("run_id").agg(F.min("ts").alias("started_at"), F.max("ts").alias("ended_at"))


def latency_summary(log: DataFrame, keys: list[str] | None = None, runs: DataFrame | None = None,
                    sort_rows: int = SORT_ROWS) -> DataFrame:
    """Counts, throughput and latencies per group; errors count as errors only.

    A success without a finite latency counts as an operation and has no part in the latencies. A group
    without a latency keeps its row, with NULL latencies. ``p50`` is the median, ``p95`` and ``p99`` are
    elements ``int(n * p)`` of the sorted latencies. Elapsed time comes from ``runs`` (``run_id``,
    ``started_at``, ``ended_at``) where given, else from the first and last record of the group.
    Two scans: counts by latency bucket, then the exact values of the buckets in question.
    """
    by = list(keys or [])
    if not by:
        log, by = log.withColumn("all_rows", F.lit(True)), ["all_rows"]
    wins = log.withColumn("us", micros(F.col("ts"))).selectExpr(
        *by, "us", "success",
        "CASE WHEN success AND abs(latency_ms) < double('Infinity') THEN latency_ms END AS latency_ms")
    # Sums of multiples of 1/1024 are exact in any order, and the small rest adds no error that counts.
    coarse = "rint(latency_ms * 1024) / 1024"
    hist = wins.groupBy(*by, F.expr(coarse_bucket("latency_ms")).alias("bucket")).agg(*map(F.expr, (
        "count(latency_ms) AS n", "count_if(success) AS ok", "count_if(NOT success) AS errors", "min(latency_ms) AS lo", "max(latency_ms) AS hi",
        f"sum({coarse}) AS coarse_ms", f"sum(latency_ms - {coarse}) AS rest_ms",
        "min(us) AS first_us", "max(us) AS last_us")))
    ranks = {**MEDIAN, "p95_ms": fraction(0.95), "p99_ms": fraction(0.99)}
    stats = {
        "operations": "sum(ok)", "timed": "sum(n)", "errors": "sum(errors)", "first_us": "min(first_us)", "last_us": "max(last_us)",
        "total_ms": "sum(coarse_ms) + sum(rest_ms)", "min_ms": "min(lo)", "max_ms": "max(hi)"}
    brackets = checkpointed(first_brackets(hist, by, ranks, *[f"{sql} AS {name}" for name, sql in stats.items()]))
    found = resolve(wins.filter("latency_ms IS NOT NULL"), by, "latency_ms", brackets, ranks, list(stats), sort_rows)
    if runs is not None:
        times = runs.select("run_id", micros(F.col("started_at")).alias("from_us"),
                            micros(F.col("ended_at")).alias("to_us"))
        found = found.drop("first_us", "last_us").join(times, "run_id", "left") \
            .withColumnsRenamed({"from_us": "first_us", "to_us": "last_us"})
    return found.selectExpr("*", "(last_us - first_us) / 1e6D AS elapsed_sec").selectExpr(
        *(keys or []), "operations", "errors", "elapsed_sec",
        "CASE WHEN elapsed_sec > 0 THEN operations / elapsed_sec END AS ops_per_sec",
        "CASE WHEN timed > 0 THEN total_ms / timed END AS avg_ms",
        "(mid_low + mid_high) / 2 AS p50_ms", "p95_ms", "p99_ms", "min_ms", "max_ms")


def latency_by_namespace(log: DataFrame, sort_rows: int = SORT_ROWS) -> DataFrame:
    """Successes, errors, mean and median per namespace; namespaces without a success are left out."""
    return latency_summary(log, ["namespace"], sort_rows=sort_rows).filter(F.col("operations") > 0).select(
        "namespace", F.col("operations").alias("queries"), "errors", "avg_ms", "p50_ms")


def hot_namespaces(by_namespace: DataFrame, n: int = M.HOT_NAMESPACES) -> DataFrame:
    """The namespaces with the most queries, and on each row how many others there are."""
    by_namespace = checkpointed(by_namespace)
    others = by_namespace.agg(F.greatest(F.count("*") - n, F.lit(0))).scalar()
    return by_namespace.orderBy(F.desc("queries"), "namespace").limit(n).select(
        namespace_label(F.col("namespace")).alias("namespace"), "queries", "errors", "avg_ms", "p50_ms",
        others.alias("others"))


def latency_extremes(by_namespace: DataFrame) -> DataFrame:
    """Fastest and slowest namespace by mean latency at two decimals; ties go to more queries, then to the name."""
    mean = F.round("avg_ms", 2)

    def first_by(order: Column) -> Column:
        return F.min_by(F.struct(namespace_label(F.col("namespace")).alias("namespace"), mean.alias("avg_ms")),
                        F.struct(order, -F.col("queries"), F.col("namespace")))

    return by_namespace.agg(first_by(mean).alias("f"), first_by(-mean).alias("s")).select(
        F.col("f.namespace").alias("fastest"), F.col("f.avg_ms").alias("fastest_avg_ms"),
        F.col("s.namespace").alias("slowest"), F.col("s.avg_ms").alias("slowest_avg_ms"))


def write_throughput(log: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Rows and batches per second of each run; only successful batches count."""
    sums = log.withColumn("us", micros(F.col("ts"))).groupBy("run_id").agg(*map(F.expr, (
        "coalesce(sum(CASE WHEN success THEN n_rows END), 0) AS rows_written", "count_if(success) AS batches",
        "count_if(NOT success) AS errors", "min(us) AS first_us", "max(us) AS last_us")))
    if runs is not None:
        times = runs.select("run_id", micros(F.col("started_at")).alias("first_us"),
                            micros(F.col("ended_at")).alias("last_us"))
        sums = sums.drop("first_us", "last_us").join(times, "run_id", "left")
    return sums.selectExpr("*", "(last_us - first_us) / 1e6D AS elapsed_sec").selectExpr(
        "run_id", "rows_written", "batches", "errors", "elapsed_sec",
        "CASE WHEN elapsed_sec > 0 THEN rows_written / elapsed_sec END AS rows_per_sec",
        "CASE WHEN elapsed_sec > 0 THEN batches / elapsed_sec END AS batches_per_sec")


def throughput_ticks(log: DataFrame, runs: DataFrame | None = None, tick_seconds: int = 1,
                     ticks_per_chunk: int = TICKS_PER_CHUNK) -> DataFrame:
    """Progress of each run per tick: remaining seconds, queries so far and in this tick, errors so far.

    Quiet ticks show 0, and records outside the time of their run do not count. Running totals are taken per chunk of ticks, from the totals of the chunks before,
    so a long run is spread over many tasks.
    """
    runs = run_times(log) if runs is None else runs
    spans = checkpointed(runs.select("run_id", micros(F.col("started_at")).alias("start_us"),
                                     micros(F.col("ended_at")).alias("end_us"))
                         .selectExpr("run_id", "start_us", "(end_us - start_us) DIV 1000000 AS seconds"))
    last = f"seconds DIV {tick_seconds}"
    counts = checkpointed(
        log.select("run_id", micros(F.col("ts")).alias("us"), "success").join(sized(spans), "run_id")
        .selectExpr("run_id", f"floor((us - start_us) / {1_000_000 * tick_seconds}) AS tick", "success", f"{last} AS last")
        .filter("tick BETWEEN 0 AND last").groupBy("run_id", "tick")
        .agg(F.expr("count_if(success) AS ok"), F.expr("count_if(NOT success) AS bad")))
    chunk = f"tick DIV {ticks_per_chunk} AS chunk"
    # Chunks first: the ticks of a long run are made by many tasks, and never as one array.
    spine = spans.selectExpr("run_id", f"{last} AS last", f"explode(sequence(0L, {last} DIV {ticks_per_chunk})) AS chunk") \
        .repartition("run_id", "chunk").selectExpr(
            "run_id", f"explode(sequence(chunk * {ticks_per_chunk}, least(last, chunk * {ticks_per_chunk} "
                      f"+ {ticks_per_chunk - 1}))) AS tick", "0L AS ok", "0L AS bad")
    # One shuffle by chunk serves the sum per tick, the join with the totals before, and the running totals.
    ticks = counts.unionByName(spine).selectExpr("*", chunk).repartition("run_id", "chunk") \
        .groupBy("run_id", "chunk", "tick").agg(F.expr("sum(ok) AS queries"), F.expr("sum(bad) AS failed"))
    chunks = counts.groupBy("run_id", F.expr(chunk)).agg(F.expr("sum(ok) AS q"), F.expr("sum(bad) AS e"))
    before = "OVER (PARTITION BY run_id ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    totals = spans.selectExpr("run_id", "seconds", f"explode(sequence(0L, {last} DIV {ticks_per_chunk})) AS chunk") \
        .join(chunks, ["run_id", "chunk"], "left").selectExpr(
            "run_id", "chunk", "seconds", f"coalesce(sum(q) {before}, 0L) AS q0", f"coalesce(sum(e) {before}, 0L) AS e0")
    upto = "OVER (PARTITION BY run_id, chunk ORDER BY tick ROWS UNBOUNDED PRECEDING)"
    return ticks.join(totals, ["run_id", "chunk"]).selectExpr(
        "run_id", "tick", f"seconds - tick * {tick_seconds} AS remaining_sec",
        f"sum(queries) {upto} + q0 AS total_queries", "queries", f"sum(failed) {upto} + e0 AS total_errors")
