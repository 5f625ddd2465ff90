"""Random inputs for the parts that run inside tasks, and for the rules they must agree with."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quillvec.functions.scoring import METRICS, LocalTopK, as_matrix, run_position

numbers = st.sampled_from([-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 1.0 + 2 ** -40, 3.0])
vectors = st.lists(st.lists(numbers, min_size=3, max_size=3), min_size=1, max_size=40)


@settings(max_examples=150, deadline=None)
@given(vectors, st.lists(st.lists(numbers, min_size=3, max_size=3), min_size=1, max_size=4), st.integers(1, 6),
       st.sampled_from(METRICS), st.integers(1, 7), st.integers(1, 3))
def test_top_k_in_any_split(rows, queries, k, metric, step, spaces):
    """Few distinct numbers make many ties and copies; every split gives the ranking of a full sort."""
    x, q = np.array(rows), np.array(queries)
    ids = np.array([f"v{i * 7 % 41}-{i}" for i in range(len(x))], dtype=object)
    which = np.arange(len(x)) % spaces
    names = [f"n{i}" for i in range(spaces)]
    top = LocalTopK(q, k, metric)
    for start in range(0, len(x), step):
        part = slice(start, start + step)
        assert not list(top.add(x[part], ids[part], names, which[part]))
    found = top.drain()
    got = {}
    for j, ns, id_, s in zip(found["query"], found["namespace"], found["id"], found["score"]):
        got.setdefault((j, ns), []).append((-s, id_))
    whole = LocalTopK(q, len(x), metric)
    list(whole.add(x, ids, names, which))
    everything = whole.drain()
    want = {}
    for j, ns, id_, s in zip(everything["query"], everything["namespace"], everything["id"], everything["score"]):
        want.setdefault((j, ns), []).append((-s, id_))
    assert {key: sorted(v) for key, v in got.items()} == {key: sorted(v)[:k] for key, v in want.items()}
    pairs = sum(len(v) for v in want.values())
    assert pairs == len(x) * len(q) if metric != "cosine" else pairs == (x.any(axis=1).sum() * q.any(axis=1).sum())


@given(st.lists(st.one_of(st.none(), st.lists(st.one_of(st.none(), st.floats(width=32)), max_size=4)), max_size=20),
       st.integers(0, 5))
def test_matrix_keeps_complete_finite_rows(rows, skip):
    column = pa.array(rows, pa.list_(pa.float32())).slice(skip)
    matrix, at = as_matrix(column, 2)
    good = [i for i, r in enumerate(rows[skip:])
            if r is not None and len(r) == 2 and all(e is not None and np.isfinite(e) for e in r)]
    assert at.tolist() == good
    assert matrix.tolist() == [[float(e) for e in rows[skip:][i]] for i in good]


@given(st.lists(st.integers(0, 4)))
def test_run_positions(groups):
    groups = sorted(groups)
    assert run_position(np.array(groups, dtype=np.int64)).tolist() == [
        i - groups.index(g) for i, g in enumerate(groups)]
