import pytest
from pyspark.sql import functions as F

from quillvec import storage
from quillvec.operators import backup, collection as C

SCHEMA = ("namespace string, id string, values array<double>, "
          "sparse_values struct<indices: array<bigint>, values: array<double>>, metadata string, seq long")


def records(spark, *rows):
    """Rows of (namespace, id, number, seq)."""
    return spark.createDataFrame([(ns, i, [float(v)], None, None, s) for ns, i, v, s in rows], SCHEMA)


def content(rows, target, **options):
    return rows(target.read(**options).select("namespace", "id", F.col("values")[0]))


@pytest.fixture
def target(spark, tmp_path):
    return C.Collection(spark, str(tmp_path / "c"))


@pytest.fixture(params=["broadcast", "shuffle"])
def join_form(request, monkeypatch):
    if request.param == "shuffle":
        monkeypatch.setattr(C, "sized", lambda df, max_rows=0: df)


def test_upsert(spark, target, rows, join_form):
    assert content(rows, target) == []
    target.upsert(records(spark, ("", "a", 1, 1), ("n", "a", 2, 1), ("n", "b", 3, 1), ("007", "a", 4, 1)))
    target.upsert(records(spark, ("n", "b", 5, 1), ("n", "b", 6, 3), ("n", "b", 7, 2), ("n", "c", 8, 1), ("x y", "a", 9, 1)))
    want = [("", "a", 1.0), ("007", "a", 4.0), ("n", "a", 2.0), ("n", "b", 6.0), ("n", "c", 8.0), ("x y", "a", 9.0)]
    assert content(rows, target) == want
    assert content(rows, target, namespace="") == [("", "a", 1.0)]
    assert content(rows, target, namespace="none") == []
    assert len(content(rows, target, number=1)) == 4


def test_upsert_twice_is_upsert_once(spark, target, rows):
    change = records(spark, *[(f"n{i % 3}", f"v{i % 40}", i, i) for i in range(200)])
    target.upsert(change)
    once = content(rows, target)
    target.upsert(change)
    assert content(rows, target) == once and len(once) == 120
    assert once == rows(C.upserted(spark.createDataFrame([], change.schema).drop("seq"), change)
                        .select("namespace", "id", F.col("values")[0]))


def test_older_changes_of_later_calls_do_nothing(spark, target, rows):
    target.upsert(records(spark, ("a", "1", 2, 2), ("a", "2", 2, 2), ("b", "1", 2, 2)))
    target.upsert(records(spark, ("a", "1", 1, 1), ("a", "2", 3, 3), ("a", "3", 1, 1), ("b", "1", 1, 1)))
    want = [("a", "1", 2.0), ("a", "2", 3.0), ("a", "3", 1.0), ("b", "1", 2.0)]
    assert content(rows, target) == want
    target.upsert(records(spark, ("a", "2", 9, 2), ("b", "1", 9, 1)))
    assert content(rows, target) == want
    target.upsert(records(spark, ("a", "1", 5, 2), ("b", "1", 5, None)))  # an equal number, and none
    assert content(rows, target) == [("a", "1", 5.0), ("a", "2", 3.0), ("a", "3", 1.0), ("b", "1", 5.0)]


def test_changes_in_any_order_and_cut(spark, target, rows):
    import random
    rng = random.Random(4)
    changes = [(f"n{rng.randint(0, 2)}", str(rng.randint(0, 9)), i, i) for i in range(60)]
    want = {(n, k): v for n, k, v, _ in changes}
    rng.shuffle(changes)
    for first in range(0, 60, 12):
        target.upsert(records(spark, *changes[first:first + 12]))
    assert content(rows, target) == sorted((n, k, float(v)) for (n, k), v in want.items())


def test_batches_with_a_bad_record_fail_alone(spark, target, rows):
    given = [("n", str(i), i, i) for i in range(10)]
    given[4] = ("n", None, 4, 4)
    given[9] = (None, "9", 9, 9)
    version, batches = target.upsert_batches(records(spark, *given), "seq", size=3)
    assert rows(batches, "batch", "n_rows", "n_bad", "success") == [
        (0, 3, 0, True), (1, 3, 1, False), (2, 3, 0, True), (3, 1, 1, False)]
    assert version.number == 1 and [r[1] for r in content(rows, target)] == ["0", "1", "2", "6", "7", "8"]
    version, batches = target.upsert_batches(records(spark, *given[4:5]), "seq", size=3)
    assert version.number == 1 and batches.filter("success").count() == 0


def test_lost_race_is_merged_again(spark, target, rows, monkeypatch):
    target.upsert(records(spark, ("a", "1", 1, 1)))
    merge, other = C.Collection.merge, C.Collection(spark, target.root)
    def late(self, *args):
        monkeypatch.setattr(C.Collection, "merge", merge)
        other.upsert(records(spark, ("a", "1", 3, 3), ("a", "2", 3, 3)))
        return merge(self, *args)
    monkeypatch.setattr(C.Collection, "merge", late)
    target.upsert(records(spark, ("a", "1", 2, 2), ("a", "3", 2, 2)))
    assert content(rows, target) == [("a", "1", 3.0), ("a", "2", 3.0), ("a", "3", 2.0)]
    assert target.version().number == 3


def test_only_replaced_namespaces_are_rewritten(spark, target, rows):
    target.upsert(records(spark, ("a", "1", 1, 1), ("b", "1", 2, 1), ("c", "1", 3, 1)))
    first = next(iter(target.version().live))
    target.upsert(records(spark, ("a", "2", 4, 1), ("b", "1", 5, 1)))
    assert target.version().live[first] == ["a", "c"]
    assert content(rows, target) == [("a", "1", 1.0), ("a", "2", 4.0), ("b", "1", 5.0), ("c", "1", 3.0)]


def test_only_files_with_replaced_records_are_rewritten(spark, target, rows, tmp_path):
    given = [(n, str(i), i, 1) for n in ("a", "x y") for i in range(60)]
    segment = target.new_segment()
    whole = records(spark, *given).repartition(6, "id")
    target.merge(target.version(), segment, target.write_segment(whole, segment))
    want = {(n, i): float(v) for n, i, v, _ in given}
    for round_, changed in enumerate((["7"], ["7", "8"], ["9"])):
        target.upsert(records(spark, *[("x y", i, 100 + round_, 2) for i in changed]))
        want.update({("x y", i): 100.0 + round_ for i in changed})
        assert content(rows, target) == sorted(((*k, v) for k, v in want.items()), key=repr)
    version = target.version()
    assert version.live[segment] == ["a", "x y"] and list(version.gone[segment]) == ["x y"]
    assert 1 <= len(version.gone[segment]["x y"]) <= 3 < len(list((tmp_path / "c").glob(
        f"segments/segment={segment}/kept=true/namespace=x y/*.parquet")))
    # What is gone is not opened, neither by readers nor by later upserts.
    for place in version.gone[segment]["x y"]:
        file = tmp_path / "c" / "segments" / f"segment={place.replace('%20', ' ')}"
        assert file.exists()
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
        file.write_bytes(b"no longer a table")
    target.upsert(records(spark, ("x y", "10", 7, 2), ("a", "10", 7, 2)))
    want.update({("x y", "10"): 7.0, ("a", "10"): 7.0})
    assert content(rows, target) == sorted(((*k, v) for k, v in want.items()), key=repr)
    target.delete_namespace("x y")
    assert "x y" not in target.version().gone.get(segment, {})


def test_pieces_of_a_namespace_stay_few(spark, target, rows, monkeypatch):
    monkeypatch.setattr(C, "MOST_PIECES", 3)
    most = 0
    for i in range(8):
        target.upsert(records(spark, ("a", str(i), i, 1), *([("b", "x", i, 1)] if i in (0, 5) else [])))
        live = target.version().live
        most = max(most, sum("a" in tokens for tokens in live.values()))
    assert most == 3
    assert content(rows, target) == [("a", str(i), float(i)) for i in range(8)] + [("b", "x", 5.0)]


def test_odd_names(spark, target, rows):
    names = ["", "a=b", "x*", "[1]", "{a,b}", "a/b", "50%", "ü ü", "_h", ".d", "x:y", "back\\slash", "?", "null", "NULL"]
    target.upsert(records(spark, *[(n, "a", 1, 1) for n in names]))
    target.upsert(records(spark, *[(n, "a", 2, 1) for n in names[::2]]))
    target.delete_namespace("x*")
    want = sorted(((n, "a", 2.0 if n in names[::2] else 1.0) for n in names if n != "x*"), key=repr)
    assert content(rows, target) == want
    for n in names:
        assert content(rows, target, namespace=n) == [w for w in want if w[0] == n]


def test_hot_id(spark, target, rows):
    target.upsert(records(spark, *[("n", "hot", i, i) for i in range(500)], ("n", "x", 1, 1)).repartition(8))
    assert content(rows, target) == [("n", "hot", 499.0), ("n", "x", 1.0)]


def test_incomplete_records_fail(spark, target):
    for row in ((None, "a", 1, 1), ("n", None, 1, 1), ("__default__", "a", 1, 1)):
        with pytest.raises(Exception):
            target.upsert(records(spark, row))
    assert target.version().number == 0


def test_dimension_is_checked_on_write(spark, target, rows):
    two = spark.createDataFrame([("n", "a", [1.0, 2.0], 1)], "namespace string, id string, values array<float>, seq long")
    target.upsert(two, dimension=2)
    assert target.version().dimension == 2 and rows(target.read(), "values", "metadata") == [([1.0, 2.0], None)]
    for bad in (records(spark, ("n", "b", 1, 1)), two.withColumn("values", F.lit(None).cast("array<double>"))):
        with pytest.raises(Exception, match="2 elements"):
            target.upsert(bad)
    assert target.version().number == 1


def test_batches_of_a_stream_count_once(spark, target, rows):
    target.upsert(records(spark, ("n", "a", 1, 1)), stream="s", batch=0)
    target.upsert(records(spark, ("n", "a", 2, 1)), stream="s", batch=0)
    assert content(rows, target) == [("n", "a", 1.0)]
    target.upsert(records(spark, ("n", "b", 2, 1)), stream="s", batch=1)
    target.upsert(records(spark, ("n", "c", 2, 1)), stream="t", batch=0)
    assert target.version().applied == {"s": 1, "t": 0} and len(content(rows, target)) == 3


def test_losing_writer_fails(spark, target):
    base = target.version()
    target.commit(base, {})
    with pytest.raises(C.CommitConflict):
        target.commit(base, {})


def test_deletes(spark, target, rows):
    assert target.delete_default_counted() == (0, 0)
    target.upsert(records(spark, ("", "a", 1, 1), ("", "b", 1, 1), ("n", "a", 2, 1), ("m", "a", 3, 1)))
    assert target.delete_default_counted() == (4, 2)
    target.delete_namespace("n")
    number = target.version().number
    target.delete_namespace("n")
    assert target.version().number == number
    assert content(rows, target) == [("m", "a", 3.0)]
    target.upsert(records(spark, ("", "z", 5, 1)))
    assert content(rows, target) == [("", "z", 5.0), ("m", "a", 3.0)]
    target.delete_all()
    assert content(rows, target) == []
    assert len(content(rows, target, number=1)) == 4


def test_stats(spark, target):
    target.upsert(records(spark, ("", "a", 1, 1), ("n", "a", 2, 1), ("n", "b", 2, 1)))
    want = [("", False, 1, 1), ("n", False, 2, 1), (None, True, 3, 1)]
    assert [tuple(r) for r in C.collection_stats(target.read()).collect()] == want
    counted = C.collection_stats(target.read(), 1)
    assert [tuple(r) for r in counted.collect()] == want
    assert "values" not in counted._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_backup(spark, target, rows, tmp_path):
    root = str(tmp_path / "backups")
    assert backup.list_backups(spark, root).count() == 0
    target.upsert(records(spark, ("", "a", 1, 1), ("n", "a", 2, 1)))
    first = backup.create_backup(target, root, "idx")
    target.delete_all()
    second = backup.create_backup(target, root, "idx", "mine", "my text", "aws", "r1")
    assert rows(backup.read_backup(target, root, first).select("namespace", "id")) == [("", "a"), ("n", "a")]
    assert backup.read_backup(target, root, second).count() == 0
    by = {r.backup_id: r for r in backup.list_backups(spark, root).collect()}
    assert (by[first].record_count, by[first].description, by[first].status) == (2, "Backup of idx", "Ready")
    assert by[first].size_bytes > 0 and by[first].size_mb == by[first].size_bytes / 1048576
    assert by[first].name.startswith("idx-backup-") and len(by[first].name) == len("idx-backup-20240101-000000")
    assert (by[second].name, by[second].description, by[second].record_count) == ("mine", "my text", 0)


def test_shared_dir_is_the_configured_one(spark):
    assert storage.new_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
