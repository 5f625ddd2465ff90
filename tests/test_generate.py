import numpy as np
import pytest

from quillvec.operators import generate as G


def test_values_do_not_depend_on_partitions(spark, rows):
    frames = [G.synthetic_vectors(G.numbers(spark, 60).repartition(p), 16) for p in (1, 4, 17)]
    first, *others = [rows(f) for f in frames]
    assert all(o == first for o in others)
    assert ("vec-0",) in [r[:1] for r in first] and len(first) == 60


def test_values_are_uniform_and_independent():
    block = G.uniform_block(np.arange(4000), 256, 0)
    assert block.min() >= -1 and block.max() < 1
    assert abs(block.mean()) < 0.005 and abs(block.var() - 1 / 3) < 0.005
    for other in (np.roll(block, 1, axis=0), np.roll(block, 1, axis=1), G.uniform_block(np.arange(4000), 256, 1)):
        assert abs(np.corrcoef(block.ravel(), other.ravel())[0, 1]) < 0.005
    far = G.uniform_block(np.arange(4000) + G.MODULUS, 256, 0)
    assert abs(np.corrcoef(block.ravel(), far.ravel())[0, 1]) < 0.005


@pytest.mark.parametrize("n, batches", [(0, 0), (1, 1), (99, 1), (100, 1), (101, 2), (250, 3)])
def test_batches(spark, n, batches):
    got = sorted(map(tuple, G.batch_sizes(G.write_batches(G.numbers(spark, n), "number")).collect()))
    assert got == [(b, min(100, n - 100 * b)) for b in range(batches)]


def test_positions_are_dense(spark):
    got = G.write_batches(G.numbers(spark, 500).repartition(7), "number").collect()
    assert [(r.number, r.number // 100) for r in got] == [(r.position, r.batch) for r in got] and len(got) == 500


def test_batches_follow_the_order_of_text_ids(spark):
    ids = spark.createDataFrame([(f"id-{i}",) for i in range(250)] + [("id-7",)], "id string")
    got = sorted((r.position, r.id) for r in G.write_batches(ids).collect())
    assert [i for _, i in got] == sorted([f"id-{i}" for i in range(250)] + ["id-7"])
    assert [p for p, _ in got] == list(range(251))


def test_metadata_and_constants(spark):
    r = G.synthetic_vectors(G.numbers(spark, 150), 4).filter("id = 'vec-149'").first()
    assert r.metadata == '{"batch_id": 1}' and len(r["values"]) == 4
    c = G.constant_records(spark.createDataFrame([("n",)], "namespace string")).first()
    assert c["values"] == [0.1] * 1024 and c.id == "test-vector-1"
