import pytest
from pyspark.sql import functions as F

from quillvec.functions import scalars, uris
from quillvec.operators import layout
from quillvec.sources import manifest as S

KEYS = {
    "p/ns1/a.parquet": "valid", "p/a.parquet": "bad_structure", "p/ns1/x/a.parquet": "bad_structure",
    "p/ns1//a.parquet": "bad_structure", "p//a.parquet": "valid", "p/ns1/A.PARQUET": "ignored",
    "p/ns1/_SUCCESS": "ignored", "p/ns1/": "skipped", "p/": "skipped", "p/ns1/.parquet": "valid",
    "p/notes.txt": "ignored", "p/x/y/z.txt": "ignored",
}
SCHEMA = "key string, size long"


def classes(spark, keys, prefix="p"):
    return layout.classify(spark.createDataFrame([(k, 1024 * 1024) for k in keys], SCHEMA), prefix)


def test_classes(spark):
    got = {r.key: (r["class"], r.namespace) for r in classes(spark, [*KEYS, "other/ns1/a.parquet"]).collect()}
    assert {k: c for k, (c, _) in got.items()} == KEYS
    assert got["p//a.parquet"][1] == "" and got["p/ns1/.parquet"][1] == "ns1" and got["p/a.parquet"][1] is None


def test_root_prefix(spark):
    r = classes(spark, ["ns1/a.parquet"], "").first()
    assert (r["class"], r.namespace, r.file) == ("valid", "ns1", "a.parquet")


@pytest.mark.parametrize("keys, verdict, accepted", [
    ([], "FAIL", False), (["p/a.parquet"], "FAIL", False), (["p/x.txt"], "FAIL", False),
    (["p/n/a.parquet"], "PASS", True), (["p/n/a.parquet", "p/x.txt"], "PASS", True),
    (["p/n/a.parquet", "p/a.parquet"], "WARN", True)])
def test_verdict(spark, keys, verdict, accepted):
    r = layout.verdict(classes(spark, keys)).first()
    assert (r.verdict, r.accepted, r.objects) == (verdict, accepted, len(keys))


def test_totals(spark):
    got = [tuple(r) for r in layout.totals(classes(spark, ["p/b/1.parquet", "p/a/1.parquet", "p/a/2.parquet", "p//x.parquet"])).collect()]
    mb = 1024 * 1024
    assert got == [("", False, 1, mb, 1.0), ("a", False, 2, 2 * mb, 2.0), ("b", False, 1, mb, 1.0),
                   (None, True, 4, 4 * mb, 4.0)]


def test_first_files(spark, rows):
    keys = [f"p/a/{i}.parquet" for i in range(5)] + ["p/b/0.parquet"] + [f"p/{i}.parquet" for i in range(7)]
    got = rows(layout.first_files(classes(spark, keys)), "class", "namespace", "position", "key", "more")
    assert got == sorted(
        [("valid", "a", i + 1, f"p/a/{i}.parquet", 2) for i in range(3)] + [("valid", "b", 1, "p/b/0.parquet", 0)]
        + [("bad_structure", None, i + 1, f"p/{i}.parquet", 2) for i in range(5)], key=repr)


def test_group_limit_comes_before_the_shuffle(spark):
    plan = layout.first_files(classes(spark, KEYS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


ARN = "arn:aws:s3:us-east-1:123:accesspoint"
URIS = {
    "s3://b/p/": ("b", "p"), "s3://b": ("b", ""), "s3://": (None, None), f"s3://{ARN}/ap/p/q": (f"{ARN}/ap", "p/q"),
    f"s3://{ARN}/ap": (f"{ARN}/ap", ""), f"s3://{ARN}/": (ARN, ""), "gs://b/p": ("b", "p"), "azure://c/p": ("c", "p"),
    "https://a.blob.core.windows.net/c/p": ("c", "p"), "https://a.blob.core.windows.net/c//": ("c", ""),
    "http://x": (None, None), "https://a.blob.core.windows.net/": (None, None), "": (None, None), "s3://b/p/q//": ("b", "p/q"),
}


def test_uri_split(spark):
    bucket, prefix = uris.split_uri(F.col("uri"))
    frame = spark.createDataFrame([(u,) for u in URIS], "uri string").select("uri", bucket.alias("b"), prefix.alias("p"))
    assert {r.uri: (r.b, r.p) for r in frame.collect()} == URIS


def test_compatibility(spark):
    kinds = {"s3": "s3://b", "gcs": "gs://b", "azure": "https://a.blob.core.windows.net/c", "skip": "azure://c"}
    allowed = {"byoc-aws": {"s3"}, "byoc-gcp": {"gcs", "azure"}, "byoc-azure": {"gcs", "azure"},
               "saas": {"s3", "gcs", "azure"}, "other": set(kinds)}
    frame = spark.createDataFrame([(e, k, u) for e in allowed for k, u in kinds.items()], "env string, kind string, uri string")
    uri = F.col("uri")
    for r in frame.select("*", uris.storage_kind(uri).alias("got"), uris.is_compatible(F.col("env"), uri).alias("ok")).collect():
        assert r.got == r.kind and r.ok == (r.kind in allowed[r.env])


def test_error_mode(spark):
    frame = spark.createDataFrame([("a",), ("Abort",), (" abc",), ("c",), ("",), (None,), ("x",)], "t string")
    got = [r[0] for r in frame.select(scalars.error_mode(F.col("t"))).collect()]
    assert got == ["ABORT"] * 3 + ["CONTINUE"] * 4


def test_listing_shows_hidden_and_empty_files(spark, tmp_path, rows):
    for name in ("a/x.parquet", "a/_g.parquet", "_u/y.parquet", "top.parquet", "my ns/é.parquet"):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"12" if name != "top.parquet" else b"")
    listed = S.list_directory(spark, str(tmp_path / "in"), chunk=2)
    assert rows(listed) == [("_u/y.parquet", 2), ("a/_g.parquet", 2), ("a/x.parquet", 2), ("my ns/é.parquet", 2),
                            ("top.parquet", 0)]
    (tmp_path / "none").mkdir()
    for empty in ("none", "missing"):
        with pytest.raises(S.EmptyListing):
            S.list_directory(spark, str(tmp_path / empty))
