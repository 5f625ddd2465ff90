"""Status histories of import and backup jobs: changes, first terminal state, outcomes, job lists.

Events of a job are ordered by ``ts, seq``. A job with very many events is cut into time slices, each worked on
by its own task; what a slice needs from earlier ones is carried over in one row per slice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillvec import model as M
from quillvec.functions.scalars import is_import_done, micros, percent_text
from quillvec.operators.generate import positions
from quillvec.storage import checkpointed, sized

SLICE_ROWS = 1_000_000
FINER = 1_000_000_000
RECORD_FIELDS = ("status", "uri", "percent_complete", "records_imported", "error")


def _crowded(rows: DataFrame, by: list[str], slice_rows: int) -> DataFrame | None:
    """Groups above ``slice_rows`` events and how to cut them: by time, or by ``seq`` where the time is one.

    There is at most one such group per ``slice_rows`` events.
    """
    found = checkpointed(rows.groupBy(*by).agg(*map(F.expr, (
        "count(*) AS n", "min(us) AS from_us", "max(us) AS to_us", "min(seq) AS from_seq", "max(seq) AS to_seq")))
        .filter(F.col("n") > slice_rows).selectExpr(
            *by, "from_us", "to_us - from_us + 1 AS us_width", "from_seq", "to_seq - from_seq + 1 AS seq_width",
            f"ceil(4 * n / {slice_rows}) AS cuts"))
    return None if found.isEmpty() else sized(found)


def _cut(rows: DataFrame, by: list[str], crowded: DataFrame, how: str, base: str) -> DataFrame:
    """Set ``slice`` to ``base`` plus the number of the cut; the order of slices is that of events."""
    columns = [c for c in rows.columns if c != "slice"]
    share = ("CASE WHEN us_width > 1 THEN CAST(us - from_us AS DOUBLE) / us_width "
             "ELSE CAST(seq - from_seq AS DOUBLE) / seq_width END")
    return rows.join(crowded, by, how).selectExpr(*columns, f"{base} + coalesce(floor({share} * cuts), 0L) AS slice")


def _sliced(rows: DataFrame, slice_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows with their ``slice``, and those of cut jobs alone, if there are any. Slices that are still crowded,
    since events came in bursts, are cut once more."""
    jobs = _crowded(rows, ["job_id"], slice_rows)
    if jobs is None:
        return rows.selectExpr("*", "0L AS slice"), None
    cut, alone = (_cut(rows, ["job_id"], jobs, how, "0L") for how in ("left", "inner"))
    bursts = _crowded(alone, ["job_id", "slice"], slice_rows)
    base = f"slice * {FINER}"
    if bursts is None:
        return cut, alone
    return tuple(_cut(df, ["job_id", "slice"], bursts, "left", base) for df in (cut, alone))


def _carry(events: DataFrame) -> DataFrame:
    """What the earlier slices of a job leave to each slice: the last record, the first time, a terminal state."""
    ends = events.groupBy("job_id", "slice").agg(
        F.expr("max_by(record, struct(ts, seq)) AS record"), F.expr("min(us) AS first_us"),
        F.expr("max(done) AS done"))
    before = "OVER (PARTITION BY job_id ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return ends.selectExpr(
        "job_id", "slice", "lag(record) OVER (PARTITION BY job_id ORDER BY slice) AS prev_before",
        f"min(first_us) {before} AS first_before", f"max(done) {before} AS over_before") \
        .filter("first_before IS NOT NULL")


def annotate(events: DataFrame, is_done: Callable[[Column], Column] = is_import_done,
             slice_rows: int = SLICE_ROWS, fields: Sequence[str] = RECORD_FIELDS) -> DataFrame:
    """Add to each event: the ``fields`` of the one before it (``prev``), seconds since the job's first event
    (``elapsed``), and whether a terminal event came before (``over``). Only the columns in use are moved."""
    rows = events.select("job_id", "ts", micros(F.col("ts")).alias("us"), "seq", F.struct(*fields).alias("record"),
                         is_done(F.col("status")).alias("done"))
    rows, cut = _sliced(rows, slice_rows)
    carry = None if cut is None else checkpointed(_carry(cut))
    w = "OVER (PARTITION BY job_id, slice ORDER BY ts, seq{})"
    before = w.format(" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    upto = w.format(" ROWS UNBOUNDED PRECEDING")
    rows = rows.selectExpr("*", f"lag(record) {w.format('')} AS prev", f"first(us) {upto} AS first_us",
                           f"coalesce(max(done) {before}, false) AS over")
    if carry is not None:
        rows = rows.join(sized(carry), ["job_id", "slice"], "left").selectExpr(
            "job_id", "us", "seq", "record", "coalesce(prev, prev_before) AS prev",
            "coalesce(first_before, first_us) AS first_us", "over OR coalesce(over_before, false) AS over")
    return rows.selectExpr("job_id", "seq", "record.*", "prev", "(us - first_us) DIV 1000000 AS elapsed", "over")


def watched(events: DataFrame, is_done: Callable[[Column], Column] = is_import_done,
            slice_rows: int = SLICE_ROWS, fields: Sequence[str] = RECORD_FIELDS) -> DataFrame:
    """Events up to and with the first terminal one of each job, annotated."""
    return annotate(events, is_done, slice_rows, fields).filter("NOT over").drop("over")


def status_changes(events: DataFrame, is_done: Callable[[Column], Column] = is_import_done,
                   slice_rows: int = SLICE_ROWS) -> DataFrame:
    """States of each job that are reported, until its first terminal one: changes, and those at every half minute."""
    return watched(events, is_done, slice_rows, ["status"]).filter(
        f"NOT (status <=> prev.status) OR elapsed % {M.REPRINT_SECONDS} = 0").select("job_id", "seq", "status", "elapsed")


def record_changes(events: DataFrame, is_done: Callable[[Column], Column] = is_import_done,
                   slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Events in which any field differs from the event before, until the first terminal one."""
    fields = ", ".join(RECORD_FIELDS)
    return watched(events, is_done, slice_rows).filter(f"NOT (struct({fields}) <=> prev)") \
        .select("job_id", "seq", "elapsed", *RECORD_FIELDS)


def job_outcomes(events: DataFrame, is_done: Callable[[Column], Column] = is_import_done) -> DataFrame:
    """One row per job: its first terminal record and the seconds until then, or its latest record so far.

    Plain aggregates, combined before the shuffle, so a job with very many events needs no slices.
    """
    timed = events.select("job_id", micros(F.col("ts")).alias("us"), "seq", *RECORD_FIELDS,
                          is_done(F.col("status")).alias("done"))
    record = f"struct(us, {', '.join(RECORD_FIELDS)})"
    ends = timed.groupBy("job_id").agg(
        F.expr("min(us) AS first_us"),
        F.expr(f"min_by(CASE WHEN done THEN {record} END, CASE WHEN done THEN struct(us, seq) END) AS ended"),
        F.expr(f"max_by({record}, struct(us, seq)) AS latest"))
    return ends.selectExpr("*", "ended IS NOT NULL AS done", "coalesce(ended, latest) AS r") \
        .withColumn("progress", percent_text(F.col("r.percent_complete"))).selectExpr(
            "job_id", "r.status", "done", "(r.us - first_us) DIV 1000000 AS elapsed",
            "coalesce(r.uri, 'N/A') AS uri", "progress", "coalesce(r.records_imported, 0) AS records_imported",
            "r.error", "first_us AS created_us", "CASE WHEN done THEN r.us END AS finished_us")


def job_history(outcomes: DataFrame) -> DataFrame:
    """Jobs, newest first, and which place each has from 0 on."""
    newest = positions(outcomes.select("job_id", "status", "uri", "progress", "records_imported", "created_us",
                                       "finished_us", "error"), F.desc("created_us"), F.desc("job_id"))
    return newest.orderBy("position")
