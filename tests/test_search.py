import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillvec.functions import scoring
from quillvec.operators import search as S

D = 16


def brute(vectors, queries, k, metric):
    """Expected rows, scored one element at a time."""
    out = []
    for qid, q in queries:
        scored = {}
        for ns, id_, v in vectors:
            if id_ is None or v is None or len(v) != D or any(x is None or not np.isfinite(x) for x in v):
                continue
            dot = sq = dd = qq = 0.0
            for a, b in zip(v, q):
                dot, sq, qq, dd = dot + a * b, sq + a * a, qq + b * b, dd + (a - b) * (a - b)
            if metric == "cosine" and (sq == 0 or qq == 0):
                continue
            score = {"dot": dot, "cosine": dot / np.sqrt(sq * qq) if sq * qq else 0.0, "euclidean": -np.sqrt(dd)}[metric]
            scored.setdefault(ns, []).append((-score, id_))
        for ns, found in scored.items():
            out += [(qid, ns, id_, -s, r + 1) for r, (s, id_) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def data():
    """One hot namespace, a third of whose rows are copies of two vectors; broken rows; small namespaces."""
    rng = np.random.default_rng(5)
    copies = rng.uniform(-1, 1, (2, D))
    vectors = []
    for i in range(600):
        v = copies[i % 2] if i % 3 == 0 else rng.uniform(-1, 1, D)
        vectors.append(("hot" if i % 4 else f"s{i % 7}", f"v{i}", [float(x) for x in v]))
    vectors += [("", f"d{i}", [float(x) for x in rng.uniform(-1, 1, D)]) for i in range(3)]
    vectors += [("hot", "short", [1.0] * (D - 1)), ("hot", "none", None), ("hot", "nan", [float("nan")] + [1.0] * (D - 1)),
                ("hot", "gap", [None] + [1.0] * (D - 1)), ("hot", None, [1.0] * D), ("hot", "zero", [0.0] * D)]
    queries = [(i, [float(x) for x in rng.uniform(-1, 1, D)]) for i in range(8)]
    queries.append((99, [float(x) for x in copies[0]]))
    return vectors, queries


def same(got, want):
    """Equal rows in equal order, with scores equal but for the order of their sums."""
    got = sorted(map(tuple, got))
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    np.testing.assert_allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12, atol=1e-14)


def frames(spark, data):
    vectors, queries = data
    return (spark.createDataFrame(vectors, "namespace string, id string, values array<double>"),
            spark.createDataFrame(queries, "qid long, qv array<double>"))


@pytest.mark.parametrize("metric", scoring.METRICS)
@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_broadcast_form(spark, data, metric, partitions):
    v, q = frames(spark, data)
    same(S.search(v.repartition(partitions), q, 10, metric).collect(), brute(*data, 10, metric))


@pytest.mark.parametrize("metric", scoring.METRICS)
def test_grid_form(spark, data, metric):
    v, q = frames(spark, data)
    got = S.search(v, q, 10, metric, broadcast_bytes=3 * 8 * D)
    same(got.collect(), brute(*data, 10, metric))


def test_grid_with_blocks_of_queries(spark, data):
    v, q = frames(spark, data)
    got = S.search(v, q, 4, "dot", broadcast_bytes=8 * D)
    same(got.collect(), brute(*data, 4, "dot"))


def test_merge_in_groups(spark, data, monkeypatch):
    monkeypatch.setattr(S, "MERGE_FAN_IN", 1)
    v, q = frames(spark, data)
    same(S.search(v.repartition(6), q, 3).collect(), brute(*data, 3, "dot"))


def test_one_namespace_and_one_query(spark, data):
    v, q = frames(spark, data)
    vectors, queries = data
    want = [r for r in brute(vectors, queries, 5, "cosine") if r[1] == "s0"]
    same(S.search_namespace(v, q, "s0", 5, "cosine").collect(), want)
    single = S.top_k(v, queries[0][1], 5, "euclidean").collect()
    want = [r for r in brute(vectors, queries[:1], 5, "euclidean") if r[1] == ""]
    assert [r.id for r in single] == [r[2] for r in sorted(want, key=lambda r: r[4])]


def test_no_queries(spark, data):
    v, q = frames(spark, data)
    assert S.search(v, q.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [2 * 8 * D, 1 << 20])
def test_odd_queries_have_no_results(spark, data, limit):
    vectors, queries = data
    v, _ = frames(spark, data)
    odd = [(100, None), (101, [1.0] * (D + 3)), (102, [float("nan")] * D), (103, [None] * D), (104, [0.0] * D)]
    q = spark.createDataFrame(queries + odd, "qid long, qv array<double>")
    same(S.search(v, q, 2, "cosine", broadcast_bytes=limit).collect(), brute(*data, 2, "cosine"))


def test_float_vectors_and_text_ids(spark, data):
    vectors, queries = data
    v, _ = frames(spark, data)
    q = spark.createDataFrame([(str(i), x) for i, x in queries], "qid string, qv array<float>")
    single = [(i, [float(np.float32(e)) for e in x]) for i, x in queries]
    got = S.search(v.withColumn("values", F.col("values").cast("array<float>")), q, 2).collect()
    rounded = [(ns, i, None if x is None else [None if e is None else float(np.float32(e)) for e in x])
               for ns, i, x in vectors]
    same([(int(r.qid), *r[1:]) for r in got], brute(rounded, single, 2, "dot"))


def test_unknown_metric(spark, data):
    v, q = frames(spark, data)
    with pytest.raises(ValueError):
        S.search(v, q, metric="hamming")


@pytest.mark.parametrize("scale", [1e-30, 1.0, 1e30])
def test_blocks_flushes_and_scales(monkeypatch, scale):
    """Small blocks, early flushes and numbers beyond single precision give the same answer."""
    monkeypatch.setattr(scoring, "ROW_BLOCK", 7)
    monkeypatch.setattr(scoring, "QUERY_BLOCK", 2)
    monkeypatch.setattr(scoring, "FLUSH_ENTRIES", 10)
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (50, D)) * scale
    x[20:40] = x[20]
    q = rng.uniform(-1, 1, (3, D))
    ids = np.array([f"v{i}" for i in range(50)], dtype=object)
    top = scoring.LocalTopK(q, 4, "dot")
    found = [*top.add(x, ids, ["a", "b"], np.arange(50) % 2), top.drain()]
    got = {t[:3]: t[3] for f in found for t in zip(f["query"], f["namespace"], f["id"], f["score"])}
    vectors = [("ab"[i % 2], ids[i], x[i].tolist()) for i in range(50)]
    for row in brute(vectors, list(enumerate(q.tolist())), 4, "dot"):
        np.testing.assert_allclose(got[row[:3]], row[3], rtol=1e-9)


def test_scores_do_not_depend_on_blocks(spark, data):
    v, q = frames(spark, data)
    forms = [S.search(v.repartition(p), q, 10, "cosine") for p in (1, 9)]
    forms.append(S.search(v, q, 10, "cosine", broadcast_bytes=2 * 8 * D))
    first, *others = [sorted(map(tuple, f.collect())) for f in forms]
    assert all(o == first for o in others)


def test_the_plan_prunes_columns_and_namespaces(spark, tmp_path, data):
    v, q = frames(spark, data)
    v.withColumn("metadata", F.lit("x")).write.partitionBy("namespace").parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    plan = S.search_namespace(stored, q, "s0")._jdf.queryExecution().toString()
    scan = plan.split("== Physical Plan ==")[1]
    assert re.search(r"PartitionFilters: \[[^\]]*namespace#\d+ = s0", scan)
    assert "metadata" not in scan


def test_queries_of_other_lengths_take_nothing_away(spark, data):
    vectors, queries = data
    v, _ = frames(spark, data)
    odd = [(200, [1.0] * (D + 1)), (201, [1.0] * (D + 1)), (202, [0.5])]
    q = spark.createDataFrame(queries[:1] + odd, "qid long, qv array<double>")
    same(S.search(v, q, 3, "dot").collect(), brute(vectors, queries[:1], 3, "dot"))
    longer = spark.createDataFrame([("a", "x", [2.0] * (D + 1))], "namespace string, id string, values array<double>")
    found = S.search(v.select("namespace", "id", "values").unionByName(longer), q, 3, "dot").filter("qid >= 200").collect()
    assert {(r.qid, r.id) for r in found} == {(200, "x"), (201, "x")}


def test_routed_queries(spark, data):
    vectors, queries = data
    v, _ = frames(spark, data)
    routed = [(i, qv, ["s0", "", None][n % 3], n % 4 if n else None) for n, (i, qv) in enumerate(queries)]
    q = spark.createDataFrame(routed, "qid long, qv array<double>, namespace string, top_k int")
    want = [r for r in brute(vectors, queries, 3, "cosine")
            if any(r[0] == i and r[1] == name and k and r[4] <= k for i, _, name, k in routed)]
    same(S.search_routed(v, q, "cosine").collect(), want)
    assert S.search_routed(v, q.limit(0)).count() == 0


def winners_of(monkeypatch, make):
    """How many rows the tasks send to the final ranking of a search, and its result."""
    sent, ranked = [], S._ranked

    def counted(winners, *args):
        sent.append(winners.count())
        return ranked(winners, *args)

    monkeypatch.setattr(S, "_ranked", counted)
    return make().collect(), sent[0]


def test_many_queries_send_only_their_best(spark, monkeypatch):
    """A task that holds more winners than it may send on keeps them until it has seen its rows."""
    n, names, each, k = 12_000, 10, 200, 10
    v = spark.range(0, n_rows := names * each, 1, 1).selectExpr(
        f"concat('n', id % {names}) AS namespace", "string(id) AS id", "array(double(id), 1D) AS values")
    q = spark.range(n).selectExpr("id AS qid", "array(double(id % 7 - 3), 0D) AS qv")
    got, sent = winners_of(monkeypatch, lambda: S.search(v, q, k).filter("qid < 7"))
    assert sent == n * names * k
    want = []
    for qid in range(7):
        for name in range(names):
            scored = sorted((-i * (qid - 3), str(i)) for i in range(name, n_rows, names))
            want += [(qid, f"n{name}", i, -float(score), r + 1) for r, (score, i) in enumerate(scored[:k])]
    assert sorted(map(tuple, got)) == sorted(want)


def test_routed_queries_meet_their_own_namespace_only(spark, data, monkeypatch):
    vectors, queries = data
    v, _ = frames(spark, data)
    q = spark.createDataFrame([(i, qv, ["s0", "s1", "hot"][i % 3], 2) for i, qv in queries],
                              "qid long, qv array<double>, namespace string, top_k int")
    got, sent = winners_of(monkeypatch, lambda: S.search_routed(v, q))
    assert len(got) == sent == 2 * len(queries)


def test_many_queries_of_one_namespace_do_not_go_to_every_task(spark, data, monkeypatch):
    """Queries in any number are neither collected nor broadcast whole."""
    v, _ = frames(spark, data)
    q = spark.range(10_000).selectExpr("id AS qid", f"transform(sequence(1, {D}), x -> double(id % 9 - x)) AS qv")
    collected, to_arrow = [], type(q).toArrow
    monkeypatch.setattr(type(q), "toArrow", lambda df: collected.append(df) or to_arrow(df))
    got = S.search_namespace(v, q, "s0", 3, "cosine").filter("qid < 9").collect()
    assert not collected
    vectors, few = data[0], [(r.qid, r.qv) for r in q.limit(9).collect()]
    same(got, [r for r in brute(vectors, few, 3, "cosine") if r[1] == "s0"])
