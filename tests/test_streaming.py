import datetime as dt

import pytest

from quillvec import model as M
from quillvec.operators import jobs
from quillvec.operators.collection import Collection
from quillvec.sources.logs import read_op_log, read_status_events
from quillvec.streaming import monitors

T0 = dt.datetime(2024, 5, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def add(spark, path, schema, rows):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


def op(i, seconds, ok=True, ns="a"):
    return ("r", i, at(seconds), "query", ns, 1, ok, 1.0)


def event(job, seconds, seq, status):
    return (job, at(seconds), seq, status, None, None, None, None)


def run(df, out, state, spark):
    query = df.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(state)) \
        .outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(str(out))


def test_ticks_with_a_late_row_and_a_restart(spark, tmp_path, rows):
    log, out, state = (tmp_path / n for n in ("log", "out", "state"))
    add(spark, log, M.OP_LOG_SCHEMA, [op(1, 0.1), op(2, 0.9, False), op(3, 1.5), op(4, 30)])
    ticks = monitors.live_throughput(read_op_log(spark, str(log), stream=True), per_namespace=False)
    assert rows(run(ticks, out, state, spark)) == [(at(0), 1, 1), (at(1), 1, 0)]
    add(spark, log, M.OP_LOG_SCHEMA, [op(5, 0.5), op(6, 30.5), op(7, 60)])  # the first of these is late
    assert rows(run(ticks, out, state, spark)) == [(at(0), 1, 1), (at(1), 1, 0), (at(30), 2, 0)]


def test_last_windows_complete_the_stream(spark, tmp_path, rows):
    log = [op(1, 0.1), op(2, 0.9, False), op(3, 9, ns="b"), op(4, 19.0), op(5, 19.999, ns="b"), op(6, 20)]
    add(spark, tmp_path / "log", M.OP_LOG_SCHEMA, log)
    for per_namespace in (True, False):
        ticks = monitors.live_throughput(read_op_log(spark, str(tmp_path / "log"), stream=True), per_namespace)
        out = run(ticks, tmp_path / f"out{per_namespace}", tmp_path / f"state{per_namespace}", spark)
        last = monitors.last_throughput(read_op_log(spark, str(tmp_path / "log")), per_namespace)
        want = [(at(0), "a", 1, 1), (at(9), "b", 1, 0), (at(19), "a", 1, 0), (at(19), "b", 1, 0), (at(20), "a", 1, 0)]
        if not per_namespace:
            want = [(at(0), 1, 1), (at(9), 1, 0), (at(19), 2, 0), (at(20), 1, 0)]
        assert out.count() == 2 and rows(out.unionByName(last)) == sorted(want, key=repr)


def test_ticks_by_namespace(spark, tmp_path, rows):
    add(spark, tmp_path / "log", M.OP_LOG_SCHEMA, [op(1, 0), op(2, 0, ns="b"), op(3, 0, ns="b"), op(4, 20)])
    ticks = monitors.live_throughput(read_op_log(spark, str(tmp_path / "log"), stream=True))
    assert rows(run(ticks, tmp_path / "out", tmp_path / "state", spark)) == [(at(0), "a", 1, 0), (at(0), "b", 2, 0)]


def test_job_monitor_over_several_batches(spark, tmp_path, rows):
    path, out, state = (tmp_path / n for n in ("events", "out", "state"))
    batches = [
        [event("a", 3, 2, "Pending"), event("a", 0, 1, "Pending"), event("b", 1, 3, "Failed")],
        [event("a", 30, 4, "Pending"), event("a", 31, 5, "Running"), event("b", 9, 6, "Running")],
        [event("a", 40, 7, "Completed"), event("a", 41, 8, "Running")],
        [event("a", 60, 9, "Failed"), event("c", 60, 10, None)],
    ]
    for batch in batches:  # one run and so one restart per batch
        got = monitored(spark, path, out, state, batch)
    log = read_status_events(spark, str(path))
    got = got.unionByName(monitors.last_changes(log))
    assert rows(got) == rows(jobs.status_changes(log))
    assert [r[1] for r in rows(got)] == [1, 4, 5, 7, 3, 10]


def state_rows(spark, state, name):
    return monitors.with_rocksdb(spark).read.format("statestore").option("stateVarName", name).load(str(state))


def monitored(spark, path, out, state, batch, **options):
    add(spark, path, M.STATUS_EVENT_SCHEMA, batch)
    stream = read_status_events(monitors.with_rocksdb(spark), str(path), stream=True)
    return run(monitors.status_monitor(stream, **options), out, state, spark)


def test_job_monitor_takes_events_in_their_order(spark, tmp_path, rows):
    """Events up to a minute late, in five micro-batches, some of a millisecond, against the batch form."""
    import random
    rng = random.Random(7)
    made = [event(f"j{rng.randint(0, 3)}", rng.randint(0, 300_000) / 1000, i, rng.choice(["Pending", "Running", None]))
            for i in range(400)]
    made += [event(f"j{k}", 200 + k, 1000 + k, "Failed") for k in range(2)] + [event("j9", 300 + i / 1e6, 2000 + i, str(i)) for i in range(4)]
    made.sort(key=lambda e: e[1] + dt.timedelta(seconds=rng.random() * 55))
    path, out, state = (tmp_path / n for n in ("events", "out", "state"))
    size = -(-len(made) // 5)
    for first in range(0, len(made), size):
        got = monitored(spark, path, out, state, made[first:first + size], delay="1 minute")
    log = read_status_events(spark, str(path))
    last = monitors.last_changes(log, delay="1 minute")
    assert rows(got.unionByName(last.select(got.columns))) == rows(jobs.status_changes(log))
    assert got.count() > 50 and last.count() > 3
    # Jobs that are over keep one flag and no events.
    waiting = {r.key.job_id for r in state_rows(spark, state, "waiting").collect()}
    done = {r.key.job_id for r in state_rows(spark, state, "job").filter("value.done").collect()}
    assert done == {"j0", "j1"} and waiting == {"j2", "j3", "j9"}


def test_job_monitor_forgets_jobs_that_are_over(spark, tmp_path, rows):
    path, out, state = (tmp_path / n for n in ("events", "out", "state"))
    options = dict(delay="10 seconds", forget_seconds=60)
    monitored(spark, path, out, state, [event("a", 0, 1, "Running"), event("a", 1, 2, "Failed"), event("b", 30, 3, "Running")], **options)
    assert state_rows(spark, state, "job").count() == 1
    monitored(spark, path, out, state, [event("a", 40, 4, "Running"), event("b", 90, 5, "Running")], **options)
    assert {r.key.job_id for r in state_rows(spark, state, "job").collect()} == {"b"}
    got = monitored(spark, path, out, state, [event("b", 200, 6, "Completed")], **options)
    assert rows(got, "job_id", "seq", "status") == [("a", 1, "Running"), ("a", 2, "Failed"), ("b", 3, "Running"), ("b", 5, "Running")]


def test_events_after_the_end_of_a_job_do_not_wait(spark, tmp_path, rows):
    path, out, state = (tmp_path / n for n in ("events", "out", "state"))
    batch = [event("a", 5, 9, "Failed"), event("a", 0, 1, "Running"), *[event("a", 6 + i, 10 + i, "Running") for i in range(20)],
             event("a", 5, 9, None), event("b", 1, 40, "Pending")]
    got = monitored(spark, path, out, state, batch, delay="1 minute")
    assert got.count() == 0
    waiting = [r.key.job_id for r in state_rows(spark, state, "waiting").collect()]
    assert sorted(waiting) == ["a", "a", "a", "b"]  # a start, an end and what shares its place
    got = monitored(spark, path, out, state, [event("c", 90, 50, "Running"), event("a", 31, 51, "Completed")], delay="1 minute")
    assert rows(got, "job_id", "seq", "status") == [("a", 1, "Running"), ("a", 9, "Failed"), ("b", 40, "Pending")]


CHANGES = ("namespace string, id string, values array<double>, "
           "sparse_values struct<indices: array<bigint>, values: array<double>>, metadata string, seq long")


def change(ns, id_, value, seq=1):
    return (ns, id_, [value], None, None, seq)


def upsert(spark, tmp_path, target, **options):
    stream = spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = monitors.continuous_upsert(stream, target, "s", **options) \
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()


def test_continuous_upsert_with_restarts(spark, tmp_path, rows):
    target = Collection(spark, str(tmp_path / "c"))
    add(spark, tmp_path / "in", CHANGES, [change("n", "a", 1.0), change("n", "b", 1.0)])
    upsert(spark, tmp_path, target)
    add(spark, tmp_path / "in", CHANGES, [change("n", "a", 2.0)])
    upsert(spark, tmp_path, target)
    upsert(spark, tmp_path, target)
    assert rows(target.read(), "id", "values") == [("a", [2.0]), ("b", [1.0])]
    assert target.version().number == 2


def test_failing_batch_does_not_stop_the_others(spark, tmp_path, rows):
    target, log = Collection(spark, str(tmp_path / "c")), str(tmp_path / "log")
    for batch in ([change("n", "a", 1.0)], [change("n", None, 1.0)], [change("n", "b", 1.0), change("n", "c", 1.0)]):
        add(spark, tmp_path / "in", CHANGES, batch)
        upsert(spark, tmp_path, target, op_log=log)
    assert rows(target.read(), "id") == [("a",), ("b",), ("c",)]
    assert rows(read_op_log(spark, log), "op_id", "n_rows", "success") == [(0, 1, True), (1, 0, False), (2, 2, True)]


def test_changes_out_of_order_and_a_batch_that_runs_again(spark, tmp_path, rows):
    target, log = Collection(spark, str(tmp_path / "c")), str(tmp_path / "log")
    for seq in (3, 1, 5, 2, 4):
        add(spark, tmp_path / "in", CHANGES, [change("n", "a", float(seq), seq), change("n", str(seq), 0.0, seq)])
    upsert(spark, tmp_path, target, op_log=log)
    want = [("1", [0.0]), ("2", [0.0]), ("3", [0.0]), ("4", [0.0]), ("5", [0.0]), ("a", [5.0])]
    assert rows(target.read(), "id", "values") == want and target.version().number == 5
    # The same input with lost progress: every batch was applied before.
    stream = spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    monitors.continuous_upsert(stream, target, "s", op_log=log).option("checkpointLocation", str(tmp_path / "anew")) \
        .trigger(availableNow=True).start().awaitTermination()
    assert rows(target.read(), "id", "values") == want and target.version().number == 5
    assert rows(read_op_log(spark, log), "op_id", "n_rows", "success") == [(i, 2, True) for i in range(5)]


def test_failing_batch_stops_a_stream_without_a_log(spark, tmp_path):
    add(spark, tmp_path / "in", CHANGES, [change("n", None, 1.0)])
    with pytest.raises(Exception):
        upsert(spark, tmp_path, Collection(spark, str(tmp_path / "c")))
