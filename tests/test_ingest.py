import math

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quillvec import model as M
from quillvec.operators import ingest, jobs
from quillvec.operators.collection import Collection
from quillvec.sources.imports import read_import, read_vector_file
from quillvec.sources.logs import read_status_events

NAMES = ["ns-1", "my ns", "tenant=1", "ü", "a+b", "a%20b", "_u", "007", "a%b"]


def write(path, ids, values=None, **more):
    path.parent.mkdir(parents=True, exist_ok=True)
    values = [[float(len(str(i)))] * 3 for i in ids] if values is None else values
    columns = {"id": pa.array(ids, pa.string()), "values": pa.array(values, pa.list_(pa.float64()))}
    pq.write_table(pa.table({**columns, **more}), path)


@pytest.fixture
def made(spark, tmp_path):
    return tmp_path / "in", Collection(spark, str(tmp_path / "collection"))


def test_namespaces_come_from_directories(spark, made, rows):
    prefix, target = made
    for n in NAMES:
        write(prefix / n / "f 1.parquet", [f"{n}-a", f"{n}-b"])
    write(prefix / "top.parquet", ["x"])
    write(prefix / "ns-1" / "deep" / "x.parquet", ["x"])
    want = sorted([(n, f"{n}-{s}") for n in NAMES for s in "ab"], key=repr)
    assert rows(read_import(spark, str(prefix)), "namespace", "id") == want
    result = ingest.import_vectors(target, str(prefix), 3)
    assert rows(target.read(), "namespace", "id") == want
    assert rows(target.read(namespace="007"), "id") == [("007-a",), ("007-b",)]
    assert ingest.rejects(target, result).count() == 0


def test_missing_and_extra_columns(spark, made, rows):
    prefix, target = made
    write(prefix / "a" / "1.parquet", ["x"])
    sparse = pa.array([{"indices": [1], "values": [0.5]}],
                      pa.struct([("indices", pa.list_(pa.int64())), ("values", pa.list_(pa.float64()))]))
    write(prefix / "a" / "2.parquet", ["y"], metadata=pa.array(["{}"]), sparse_values=sparse, other=pa.array([1]))
    ingest.import_vectors(target, str(prefix), 3)
    assert rows(target.read(), "id", "metadata", "sparse_values") == [("x", None, None), ("y", "{}", ([1], [0.5]))]


def test_float_vectors(spark, made):
    prefix, target = made
    (prefix / "a").mkdir(parents=True)
    pq.write_table(pa.table({"id": ["x"], "values": pa.array([[0.1, 0.2, 0.3]], pa.list_(pa.float32()))}),
                   prefix / "a" / "f.parquet")
    ingest.import_vectors(target, str(prefix), 3)
    assert math.isclose(target.read().first()["values"][0], 0.1, rel_tol=1e-6)


def test_bad_records_and_files(spark, made, rows):
    prefix, target = made
    v, nan = [1.0, 2.0, 3.0], float("nan")
    write(prefix / "a" / "1.parquet", ["ok", None, "null", "short", "long", "empty", "nan", "gap", "inf", "twice", "twice"],
          [v, v, None, v[:2], v + v, [], [nan, 1.0, 2.0], [None, 1.0, 2.0], [math.inf, 1.0, 2.0], v, [4.0, 5.0, 6.0]])
    write(prefix / "a" / "2.parquet", ["twice", "bad twice"], [[7.0, 8.0, 9.0], None])
    write(prefix / "b" / "norows.parquet", [])
    write(prefix / "b" / "_g.parquet", ["hidden"])
    (prefix / "b" / "corrupt[1].parquet").write_bytes(b"PAR1 this is no parquet file PAR1")
    (prefix / "b" / "zero.parquet").write_bytes(b"")
    result = ingest.import_vectors(target, str(prefix), 3)
    assert rows(target.read(), "namespace", "id", "values") == [("a", "ok", v), ("a", "twice", [7.0, 8.0, 9.0])]
    assert rows(ingest.rejects(target, result), "id", "file", "reasons") == sorted([
        (None, "a/1.parquet", ["missing_id"]), ("null", "a/1.parquet", ["missing_values"]),
        ("short", "a/1.parquet", ["wrong_dimension"]), ("long", "a/1.parquet", ["wrong_dimension"]),
        ("empty", "a/1.parquet", ["wrong_dimension"]), ("nan", "a/1.parquet", ["bad_value"]),
        ("gap", "a/1.parquet", ["bad_value"]), ("inf", "a/1.parquet", ["bad_value"]),
        ("twice", "a/1.parquet", ["repeated_id"]), ("twice", "a/1.parquet", ["repeated_id"]),
        ("bad twice", "a/2.parquet", ["missing_values"]), (None, "b/_g.parquet", ["hidden_name"]),
        (None, "b/corrupt[1].parquet", ["corrupt_file"]), (None, "b/zero.parquet", ["empty_file"]),
    ], key=repr)


def test_accepted_and_rejected_make_up_the_input(spark, made):
    prefix, target = made
    ids = [None if i % 7 == 0 else f"v{i % 50}" for i in range(200)]
    write(prefix / "a" / "1.parquet", ids, [[1.0] * (3 - (i % 5 == 0)) for i in range(200)])
    result = ingest.import_vectors(target, str(prefix), 3)
    assert target.read().count() + ingest.rejects(target, result).count() == 200
    assert target.read().count() == target.read().select("id").distinct().count()


def test_file_cut_short(spark, made, rows):
    """A file with a sound footer and broken data: what it gave stays, and the file is reported."""
    prefix, target = made
    write(prefix / "a" / "good.parquet", ["x"])
    path = prefix / "a" / "broken.parquet"
    path.parent.mkdir(parents=True, exist_ok=True)
    n = 20_000
    pq.write_table(pa.table({"id": [f"i{i}" for i in range(n)], "values": [[float(i)] * 3 for i in range(n)]}), path,
                   row_group_size=1000, compression="gzip", use_dictionary=False)
    data = bytearray(path.read_bytes())
    middle = len(data) // 2
    data[middle:middle + 4000] = b"\xff" * 4000
    path.write_bytes(bytes(data))
    result = ingest.import_vectors(target, str(prefix), 3)
    assert rows(ingest.rejects(target, result), "file", "reasons") == [("a/broken.parquet", ["cut_short"])]
    with pytest.raises(Exception):
        ingest.import_vectors(target, str(prefix), 3, M.ABORT)


def test_abort_commits_nothing(spark, made):
    prefix, target = made
    write(prefix / "a" / "1.parquet", ["x", "y"], [[1.0] * 3, None])
    with pytest.raises(ingest.ImportAborted, match="missing_values"):
        ingest.import_vectors(target, str(prefix), 3, M.ABORT)
    assert target.version().number == 0
    (prefix / "a" / "2.parquet").write_bytes(b"nothing")
    with pytest.raises(Exception):
        ingest.import_vectors(target, str(prefix), 3, M.ABORT)
    assert target.version().number == 0
    write(prefix / "a" / "1.parquet", ["x"])
    write(prefix / "a" / "2.parquet", ["y"])
    ingest.import_vectors(target, str(prefix), 3, M.ABORT)
    assert target.read().count() == 2


def test_abort_leaves_nothing_on_disk(spark, made):
    prefix, target = made
    write(prefix / "a" / "1.parquet", ["x", "y"], [[1.0] * 3, None])
    with pytest.raises(ingest.ImportAborted):
        ingest.import_vectors(target, str(prefix), 3, M.ABORT)
    write(prefix / "a" / "1.parquet", ["x", "x"])  # sound records, but one id
    with pytest.raises(ingest.ImportAborted, match="repeated_id"):
        ingest.import_vectors(target, str(prefix), 3, M.ABORT)
    write(prefix / "a" / "1.parquet", ["x"])
    (prefix / "a" / "2.parquet").write_bytes(b"PAR1 and so on PAR1")
    with pytest.raises(ingest.ImportAborted, match="corrupt_file"):
        ingest.import_vectors(target, str(prefix), 3, M.ABORT)
    assert not (prefix.parent / "collection").exists()


def test_imports_leave_job_records(spark, made, tmp_path):
    prefix, target = made
    jobs_table = str(tmp_path / "jobs")
    write(prefix / "a" / "1.parquet", ["x", "y", None])
    with pytest.raises(ingest.ImportAborted):
        ingest.import_vectors(target, str(prefix), 3, M.ABORT, jobs_table, "first")
    ingest.import_vectors(target, str(prefix), 3, M.CONTINUE, jobs_table, "second")
    events = read_status_events(spark, jobs_table)
    assert sorted((e.job_id, e.seq, e.status) for e in events.collect()) == [
        ("first", 0, "InProgress"), ("first", 1, "Failed"), ("second", 0, "InProgress"), ("second", 1, "Completed")]
    found = {j.job_id: j for j in jobs.job_outcomes(events).collect()}
    assert "missing_id" in found["first"].error and found["first"].records_imported == 0
    assert (found["second"].records_imported, found["second"].error, found["second"].uri) == (2, None, str(prefix))
    assert all(j.finished_us >= j.created_us for j in found.values())


def test_import_into_a_filled_collection(spark, made, rows):
    prefix, target = made
    write(prefix / "1" / "a" / "f.parquet", ["x", "y"], [[1.0] * 3, [2.0] * 3])
    write(prefix / "2" / "a" / "f.parquet", ["y", "z"], [[3.0] * 3, [4.0] * 3])
    write(prefix / "2" / "b" / "f.parquet", ["x"], [[5.0] * 3])
    ingest.import_vectors(target, str(prefix / "1"), 3)
    ingest.import_vectors(target, str(prefix / "2"), 3)
    assert rows(target.read().select("namespace", "id", F.col("values")[0])) == [
        ("a", "x", 1.0), ("a", "y", 3.0), ("a", "z", 4.0), ("b", "x", 5.0)]
    with pytest.raises(ValueError, match="dimension 3"):
        ingest.import_vectors(target, str(prefix / "2"), 4)


def test_nothing_to_import(spark, made):
    prefix, target = made
    assert read_import(spark, str(prefix)).count() == 0
    for mode in (M.CONTINUE, M.ABORT):
        with pytest.raises(ValueError):
            ingest.import_vectors(target, str(prefix), 3, mode)
    write(prefix / "top.parquet", ["x"])
    with pytest.raises(ingest.ImportAborted):
        ingest.import_vectors(target, str(prefix), 3)
    assert target.version().number == 0


@pytest.mark.parametrize("name, content", [("_g.parquet", None), (".g.parquet", None), ("zero.parquet", b""),
                                           ("bad.parquet", b"PAR1 and so on PAR1")])
def test_abort_on_files_that_are_not_read(spark, made, name, content):
    prefix, target = made
    write(prefix / "a" / "f.parquet", ["x"])
    if content is None:
        write(prefix / "a" / name, ["y"])
    else:
        (prefix / "a" / name).write_bytes(content)
    with pytest.raises(Exception):  # Spark names the file that can't be read
        ingest.import_vectors(target, str(prefix), 3, M.ABORT)
    assert target.version().number == 0
    result = ingest.import_vectors(target, str(prefix), 3)
    assert [r.file for r in ingest.rejects(target, result).collect()] == [f"a/{name}"]


def test_abort_accepts_an_empty_table(spark, made):
    prefix, target = made
    write(prefix / "a" / "f.parquet", ["x"])
    write(prefix / "a" / "none.parquet", [])
    assert ingest.import_vectors(target, str(prefix), 3, M.ABORT).version.number == 1


@pytest.mark.parametrize("limit", [0, 1 << 24])
def test_empty_tables_are_sound_whatever_their_footer(spark, made, monkeypatch, limit):
    monkeypatch.setattr(ingest, "FOOTER_ONLY_BYTES", limit)
    prefix, target = made
    write(prefix / "a" / "f.parquet", ["x"])
    write(prefix / "a" / "none.parquet", [])
    (prefix / "a" / "bad.parquet").write_bytes(b"PAR1 and so on PAR1")
    result = ingest.import_vectors(target, str(prefix), 3)
    assert [(r.file, list(r.reasons)) for r in ingest.rejects(target, result).collect()] == [
        ("a/bad.parquet", ["corrupt_file"])]


def test_long_lists_of_any_kind_are_cut(spark):
    df = spark.createDataFrame([(list(range(8)), list("abcdefgh"), [True], None)],
                               "a array<bigint>, b array<string>, c array<boolean>, d array<int>")
    got = ingest.preview(df).first()
    assert (got.a, got.b, got.c, got.d) == ("[0, 1, 2, ... ] (8 elements)", "[a, b, c, ... ] (8 elements)", "[true]", None)


def test_import_check(spark, made):
    prefix, _ = made
    write(prefix / "a" / "f.parquet", ["x"])
    write(prefix / "f.parquet", ["x"])
    assert ingest.import_check(spark, str(prefix)).first().verdict == "WARN"


def test_profile_and_preview(spark, made):
    prefix, _ = made
    path = prefix / "a" / "f.parquet"
    write(path, ["i" * 200, "j" * 201, None], [[1e-05, 0.1, 1e16, 1.0, 2.0], [1.5, -0.0, 3e22, 1.0, 2.0, 3.0], None],
          n=pa.array([1, 2, 3]))
    frame = read_vector_file(spark, str(path))
    p = ingest.vector_profile(frame).first()
    assert (p.n_rows, p.n_columns, p.with_values, p.min_dimension, p.max_dimension) == (3, 3, 2, 5, 6)
    assert (p.has_sparse_column, p.with_sparse, p.with_metadata) == (False, 0, 0)
    assert [tuple(r) for r in ingest.preview(frame).collect()] == [
        ("i" * 200, "[1e-05, 0.1, 1e+16, 1.0, 2.0]", "1"),
        ("j" * 200 + "...", "[1.5, -0.0, 3e+22, ... ] (6 elements)", "2"), (None, None, "3")]
    assert ingest.first_row_preview(frame).count() == 1
    empty = ingest.vector_profile(frame.limit(0)).first()
    assert (empty.n_rows, empty.min_dimension) == (0, None)
    assert ingest.vector_profile(frame.select("n")).first().max_dimension is None
