import datetime as dt
import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillvec.operators import metrics

LOG = "run_id string, ts timestamp_ntz, namespace string, n_rows long, success boolean, latency_ms double"
T0 = dt.datetime(2024, 5, 1)


def log(spark, rows):
    """Rows of (seconds, namespace, success, latency) in run r."""
    return spark.createDataFrame(
        [("r", T0 + dt.timedelta(seconds=s), ns, 100, ok, ms) for s, ns, ok, ms in rows], LOG)


def rule(values, p):
    return sorted(values)[int(len(values) * p)]


@pytest.mark.parametrize("n", [1, 2, 3, 19, 20, 21, 100, 101])
def test_order_statistics_of_whole_numbers(spark, n):
    values = [float(v) for v in range(1, n + 1)]
    frame = log(spark, [(i, "a", True, v) for i, v in enumerate(reversed(values))] + [(n, "a", False, 0.0)])
    r = metrics.latency_summary(frame).first()
    assert (r.operations, r.errors) == (n, 1)
    assert (r.p50_ms, r.p95_ms, r.p99_ms) == (statistics.median(values), rule(values, 0.95), rule(values, 0.99))
    assert (r.min_ms, r.max_ms, r.avg_ms) == (1.0, float(n), statistics.mean(values))
    assert r.elapsed_sec == float(n) and r.ops_per_sec == 1.0


@pytest.mark.parametrize("sort_rows", [1, 7, 10_000])
@pytest.mark.parametrize("shape", ["uniform", "lognormal", "one value", "outliers", "negative"])
def test_narrowing_is_exact(spark, sort_rows, shape):
    """Whatever the buckets, the elements are those of the sorted list; one namespace holds most rows."""
    rng = np.random.default_rng(3)
    values = {
        "uniform": rng.uniform(0, 1, 3000), "lognormal": rng.lognormal(3, 2, 3000), "one value": np.full(3000, 5.25),
        "outliers": np.r_[np.full(1500, 1.0), rng.uniform(1, 1 + 1e-9, 1499), 1e12],
        "negative": rng.normal(0, 100, 3000),
    }[shape].tolist()
    names = ["hot" if i % 3 else f"n{i % 12}" for i in range(3000)]
    frame = log(spark, [(i, ns, True, v) for i, (ns, v) in enumerate(zip(names, values))])
    for r in metrics.latency_summary(frame, ["namespace"], sort_rows=sort_rows).collect():
        mine = [v for ns, v in zip(names, values) if ns == r.namespace]
        assert r.p50_ms == statistics.median(mine)
        assert (r.p95_ms, r.p99_ms) == (rule(mine, 0.95), rule(mine, 0.99))
        assert math.isclose(r.avg_ms, statistics.mean(mine), rel_tol=1e-14, abs_tol=1e-12)


def test_group_without_success(spark):
    frame = log(spark, [(0, "a", False, 0.0), (5, "a", False, 0.0), (1, "b", True, 2.0)])
    by = {r.namespace: r for r in metrics.latency_summary(frame, ["namespace"]).collect()}
    assert (by["a"].operations, by["a"].errors, by["a"].avg_ms, by["a"].p95_ms) == (0, 2, None, None)
    assert [r.namespace for r in metrics.latency_by_namespace(frame).collect()] == ["b"]


def test_run_of_no_length(spark):
    r = metrics.latency_summary(log(spark, [(0, "a", True, 1.0)]), ["run_id"]).first()
    assert (r.elapsed_sec, r.ops_per_sec) == (0.0, None)
    w = metrics.write_throughput(log(spark, [(0, "a", True, 1.0)])).first()
    assert (w.rows_written, w.rows_per_sec, w.batches_per_sec) == (100, None, None)


def test_run_table_sets_the_time(spark):
    frame = log(spark, [(1, "a", True, 1.0), (2, "a", False, 1.0)])
    runs = spark.createDataFrame([("r", T0, T0 + dt.timedelta(seconds=10))],
                                 "run_id string, started_at timestamp_ntz, ended_at timestamp_ntz")
    assert metrics.latency_summary(frame, ["run_id"], runs).first().ops_per_sec == 0.1
    w = metrics.write_throughput(frame, runs).first()
    assert (w.rows_written, w.batches, w.errors, w.rows_per_sec) == (100, 1, 1, 10.0)


def test_hot_and_extreme_namespaces(spark):
    spec = {"": (3, 5.0), "b": (3, 1.001), "a": (2, 1.004), "c": (5, 9.0), "d": (1, 9.0)}
    frame = log(spark, [(i, ns, True, ms) for ns, (n, ms) in spec.items() for i in range(n)] + [(0, "e", False, 0.0)])
    by = metrics.latency_by_namespace(frame)
    hot = metrics.hot_namespaces(by, 3).collect()
    assert [(r.namespace, r.queries, r.others) for r in hot] == [("c", 5, 2), ("(default)", 3, 2), ("b", 3, 2)]
    r = metrics.latency_extremes(by).first()
    assert (r.fastest, r.slowest) == ("b", "c")  # equal at two decimals: more queries first


@pytest.mark.parametrize("chunk", [2, 3600])
def test_ticks(spark, chunk):
    frame = log(spark, [(0, "a", True, 1.0), (0.5, "a", True, 1.0), (3, "a", False, 0.0), (6.2, "a", True, 1.0)])
    got = [tuple(r)[1:] for r in metrics.throughput_ticks(frame, ticks_per_chunk=chunk).orderBy("tick").collect()]
    assert got == [(0, 6, 2, 2, 0), (1, 5, 2, 0, 0), (2, 4, 2, 0, 0), (3, 3, 2, 0, 1), (4, 2, 2, 0, 1),
                   (5, 1, 2, 0, 1), (6, 0, 3, 1, 1)]


def test_ticks_of_a_run_with_errors_only(spark):
    frame = log(spark, [(0, "a", False, 0.0), (2, "a", False, 0.0)])
    got = [tuple(r)[1:] for r in metrics.throughput_ticks(frame).orderBy("tick").collect()]
    assert got == [(0, 2, 0, 0, 1), (1, 1, 0, 0, 1), (2, 0, 0, 0, 2)]


def test_successes_without_a_latency(spark):
    rows = [(1.0, True), (2.0, True), (3.0, True), (None, True), (float("nan"), True), (float("inf"), True), (9.0, False)]
    log = spark.createDataFrame([(f"r{i % 1}", i, v, ok) for i, (v, ok) in enumerate(rows)],
                                "run_id string, s long, latency_ms double, success boolean") \
        .withColumn("ts", F.timestamp_seconds("s"))
    for sort_rows in (1, 10):
        got = metrics.latency_summary(log, ["run_id"], sort_rows=sort_rows).first()
        assert (got.operations, got.errors, got.avg_ms, got.p50_ms, got.max_ms) == (6, 1, 2.0, 2.0, 3.0)


def test_ticks_of_a_run_of_decades(spark):
    log = spark.createDataFrame([("r", 0, True), ("r", 54 * 365 * 86400, True)], "run_id string, s long, success boolean") \
        .withColumn("ts", F.timestamp_seconds("s"))
    ticks = metrics.throughput_ticks(log, tick_seconds=3600)
    assert ticks.agg(F.count("*"), F.sum("queries"), F.max("total_queries")).first() == (54 * 365 * 24 + 1, 2, 2)
