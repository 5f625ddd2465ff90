import datetime as dt
import random

import pytest

from quillvec.functions.scalars import is_backup_done
from quillvec.operators import jobs

SCHEMA = ("job_id string, ts timestamp_ntz, seq long, status string, uri string, percent_complete double, "
          "records_imported long, error string")
T0 = dt.datetime(2024, 5, 1)


def events(spark, rows):
    """Rows of (job, seconds, seq, status[, percent])."""
    return spark.createDataFrame(
        [(r[0], T0 + dt.timedelta(seconds=r[1]), r[2], r[3], None, r[4] if len(r) > 4 else None, None, None)
         for r in rows], SCHEMA)


def test_changes_until_terminal(spark, rows):
    frame = events(spark, [
        ("a", 0, 1, "Pending"), ("a", 10, 2, "Pending"), ("a", 30, 3, "Pending"), ("a", 31, 4, "Running"),
        ("a", 40, 5, "Pending"), ("a", 41, 6, "Completed"), ("a", 42, 7, "Pending"), ("a", 43, 8, "Failed"),
        ("b", 5, 9, None), ("b", 6, 10, "Running"), ("b", 7, 11, None), ("b", 8, 12, None),
    ])
    assert rows(jobs.status_changes(frame)) == [
        ("a", 1, "Pending", 0), ("a", 3, "Pending", 30), ("a", 4, "Running", 31), ("a", 5, "Pending", 40),
        ("a", 6, "Completed", 41), ("b", 10, "Running", 1), ("b", 11, None, 2), ("b", 9, None, 0)]


def test_record_changes(spark, rows):
    frame = events(spark, [("a", 0, 1, "R", 1.0), ("a", 1, 2, "R", 1.0), ("a", 2, 3, "R", 2.0), ("a", 3, 4, "R"),
                           ("a", 4, 5, "R"), ("a", 5, 6, "Failed"), ("a", 6, 7, "R")])
    assert [r[0] for r in rows(jobs.record_changes(frame), "seq")] == [1, 3, 4, 6]


def test_outcomes_and_history(spark):
    frame = events(spark, [("a", 0, 1, "Pending"), ("a", 7, 2, "Failed"), ("a", 9, 3, "Completed"),
                           ("b", 3, 4, "Pending"), ("b", 5, 5, "Running", 12.34)])
    out = {r.job_id: r for r in jobs.job_outcomes(frame).collect()}
    assert (out["a"].status, out["a"].done, out["a"].elapsed, out["a"].progress) == ("Failed", True, 7, "N/A")
    assert (out["b"].status, out["b"].done, out["b"].elapsed, out["b"].progress) == ("Running", False, 2, "12.3%")
    assert out["b"].finished_us is None and out["b"].records_imported == 0 and out["b"].uri == "N/A"
    assert [r.job_id for r in jobs.job_history(jobs.job_outcomes(frame)).collect()] == ["b", "a"]


def test_backup_states(spark, rows):
    frame = events(spark, [("a", 0, 1, "Completed"), ("a", 1, 2, "Ready"), ("a", 2, 3, "Failed")])
    assert [r[0] for r in rows(jobs.status_changes(frame, is_backup_done), "seq")] == [1, 2]


@pytest.mark.parametrize("times", ["spread", "bursts", "one"])
@pytest.mark.parametrize("slice_rows", [1, 5, 40])
def test_slices_do_not_change_results(spark, rows, slice_rows, times):
    """One job holds most events, many at equal times; another ends half-way."""
    rnd = random.Random(slice_rows)
    spec = []
    for seq in range(300):
        job = "hot" if rnd.random() < 0.7 else rnd.choice(["ended", "x", "y"])
        status = rnd.choice(["Pending", "Running", None]) if job != "ended" or seq < 150 else "Completed"
        hot = {"spread": rnd.randrange(0, 90), "bursts": rnd.choice([0, 50, 50, 50, 5000]), "one": 7}[times]
        spec.append((job, hot if job == "hot" else seq, seq, status, float(rnd.randrange(2))))
    frame = events(spark, spec)
    for operator in (jobs.status_changes, jobs.record_changes):
        assert rows(operator(frame, slice_rows=slice_rows)) == rows(operator(frame))
