"""Scans read what they need: columns, partitions and filters as they reach the files."""

import re

import pytest
from conftest import SMALL
from quillvec.operators import collection as C, generate, ingest, jobs, layout, metrics
from quillvec.plans import views as V
from quillvec.sources.imports import footer_row_counts, read_import


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("plans")
    V.write_import_layout(V.raw_records(spark, SMALL), str(base / "in"))
    target = C.Collection(spark, str(base / "c"))
    ingest.import_vectors(target, str(base / "in"), V.DIMENSION)
    return str(base / "in"), target


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def schemas(df):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>\s", plan(df))]


def test_counts_come_from_footers(spark, loaded):
    prefix, target = loaded
    assert schemas(footer_row_counts(spark, prefix)) == [set()]
    assert schemas(C.collection_stats(target.read(), V.DIMENSION)) == [set()]


def test_ids_are_compared_without_vectors(spark, loaded):
    prefix, target = loaded
    assert schemas(read_import(spark, prefix).groupBy("namespace", "id").count()) == [{"id"}]
    assert schemas(target._live_rows(target.version().live).select("segment", "token", "id")) == [{"id"}]


def test_one_namespace_is_one_directory(loaded):
    _, target = loaded
    files = target.read(namespace="ns-3").inputFiles()
    assert files and all("/namespace=ns-3/" in f for f in files)


@pytest.mark.parametrize("df, columns", [
    (lambda s: metrics.write_throughput(V.op_log(V.events(s, SMALL))), {"ts", "event_type"}),
    (lambda s: jobs.status_changes(V.status_events(V.events(s, SMALL))), {"event_id", "ts", "user_id", "event_type"}),
    (lambda s: layout.verdict(layout.classify(V.manifest(s, SMALL), V.PREFIX)), {"doc_id", "source"}),
])
def test_columns(spark, df, columns):
    assert columns in schemas(df(spark))


def test_upserts_limit_groups_before_the_shuffle(spark):
    assert plan(C.newest(V.changes(spark, SMALL))).count("WindowGroupLimit") == 2


def test_numbering_sorts_no_whole_table(spark):
    """Windows without a partition run over bucket counts only."""
    text = plan(generate.write_batches(V.numbered(spark, SMALL), "number"))
    single = [line for line in text.split("\n") if "Exchange SinglePartition" in line]
    assert len(single) == 1 and "BroadcastExchange" in text
