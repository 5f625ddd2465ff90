"""Results do not depend on how the input is split."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from quillvec.operators import collection, generate, ingest, jobs, layout, metrics
from quillvec.plans import views as V

OPERATORS = {
    "latency": lambda s, p: metrics.latency_summary(V.op_log(p(V.events(s, SMALL))), ["namespace"]),
    "whole log": lambda s, p: metrics.latency_summary(V.op_log(p(V.events(s, SMALL)))),
    "hot": lambda s, p: metrics.hot_namespaces(metrics.latency_by_namespace(V.op_log(p(V.events(s, SMALL)))), 5),
    "ticks": lambda s, p: metrics.throughput_ticks(V.op_log(p(V.events(s, SMALL))), tick_seconds=600),
    "status": lambda s, p: jobs.status_changes(V.status_events(p(V.events(s, SMALL))), slice_rows=20),
    "outcomes": lambda s, p: jobs.job_outcomes(V.status_events(p(V.events(s, SMALL)))),
    "files": lambda s, p: layout.first_files(layout.classify(p(V.manifest(s, SMALL)), V.PREFIX)),
    "totals": lambda s, p: layout.totals(layout.classify(p(V.manifest(s, SMALL)), V.PREFIX)),
    "batches": lambda s, p: generate.write_batches(p(V.numbered(s, SMALL)), "number"),
    "upsert": lambda s, p: collection.upserted(
        p(V.vectors(s, SMALL).withColumn("metadata", F.lit(None).cast("string"))), p(V.changes(s, SMALL))),
    "newest": lambda s, p: collection.newest(p(V.changes(s, SMALL).withColumn("seq", F.lit(1)))),
    "check": lambda s, p: ingest.check_records(p(V.raw_records(s, SMALL)), V.DIMENSION),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_splits(spark, rows, name):
    first, *others = [rows(OPERATORS[name](spark, lambda df, n=n: df.repartition(n))) for n in (1, 4, 17)]
    assert first and all(o == first for o in others)
