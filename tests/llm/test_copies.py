"""Similarity join, passages and repeated strings against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from plain import (components, empty_documents, odd_documents, without_passages, without_strings)
from quillvec.llm import jaccard, phrases, suffixes
from quillvec.llm.components import connected_components
from quillvec.llm.prefix_tree import PrefixTree, forest
from quillvec.llm.tables import Scratch
from quillvec.llm.words import Words, text_slices


@pytest.fixture(scope="module")
def docs(spark):
    return odd_documents(spark, spark.read.parquet(f"{SMALL}/documents.parquet")).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def by_text(values):
    return sorted(values, key=repr)


def test_passages(docs, texts):
    got = phrases.removed_passages(docs).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert by_text(map(tuple, got)) == by_text(without_passages(texts))


def test_passages_in_many_parts(docs, texts, monkeypatch):
    monkeypatch.setattr(phrases, "CLASSES_PER_PART", 2)
    got = phrases.removed_passages(docs).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert by_text(map(tuple, got)) == by_text(without_passages(texts))


def test_small_automata_find_the_same(monkeypatch):
    classes = [(" ".join(f"w{i + j}" for j in range(17)), i, i + 40) for i in range(0, 60, 3)]
    found = {}
    for size in (2, 1000):
        monkeypatch.setattr(phrases, "PASSAGES_PER_AUTOMATON", size)
        monkeypatch.setattr(phrases, "STREAMS_PER_AUTOMATON", size)
        import pyarrow as pa
        names = ("key", "part", "kind", "whole", "stretch", "windows", "owner", "last")
        rows = [(7, 0, 0, k, words, [int(words.split()[0][1:]) + j for j in range(5)], a, b)
                for k, (words, a, b) in enumerate(classes)] + [(7, 0, 1, i, None, None, i % 5, 99) for i in range(60)]
        batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)
        covered = {}
        for out in phrases._stream(iter([batch]), 13):
            for r in out.to_pylist():
                for w in range(r["start"], r["end"]):
                    at = (r["whole"], w)
                    covered[at] = min(r["owner"], covered.get(at, 99))
        found[size] = covered
    assert found[2] == found[1000] != {}


def test_one_phrase_of_very_many_classes(spark):
    """Classes 2k and 2k + 1 share their first window, in different parts of the phrase."""
    n = 50_000
    rows = [(7, k, k, k, 25, " ".join([f"a{k // 2}w{j}" for j in range(13)] + [f"b{k}"]), [k // 2, n + k]) for k in range(n)]
    stretches = spark.createDataFrame(
        rows, "key long, whole long, owner long, last long, parts int, stretch string, windows array<long>").repartition(8)
    found = phrases._located(stretches, 13, Scratch(spark, "many"))
    got = {(r.whole, r.start, r.end, r.owner) for r in found.collect()}
    assert got == {(k, 0, 13, k - 1) for k in range(1, n, 2)}


def test_phrases_with_one_class_and_with_several(spark):
    common, tail = [f"p{i}" for i in range(30)], [f"q{i}" for i in range(20)]
    texts = [" ".join(common), " ".join([*common, "x"]), " ".join(common[:20] + tail), " ".join(["y", *tail]),
             " ".join(common[5:18]), " ".join(tail[:12])] * 2
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = phrases.removed_passages(docs).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert by_text(map(tuple, got)) == by_text(without_passages(rows))


def test_passage_text_keeps_its_other_white_space(spark):
    passage = " ".join(f"p{i}" for i in range(13))
    docs = spark.createDataFrame([(1, passage), (2, f"a\n\nb {passage}  c\td")], "doc_id long, text string")
    got = {r.doc_id: r for r in phrases.removed_passages(docs).collect()}
    assert got[1].text == passage and got[1].removed == []
    assert got[2].text == "a\n\nb c\td" and got[2].removed == [(2, 15)] and got[2].kept == "a b c d"


def test_strings(docs, texts):
    got = suffixes.without_repeats(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans"), "kept").collect()
    assert by_text((*r[:4], bytes(r[4])) for r in got) == by_text(without_strings(texts))


def test_short_threshold(spark):
    docs = spark.createDataFrame([(1, "abcabcabcX"), (2, "bca"), (3, "zzz"), (4, None)], "doc_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = suffixes.without_repeats(docs, 3).select("doc_id", "n_bytes", "n_removed", F.size("spans"), "kept").collect()
    assert by_text((*r[:4], bytes(r[4])) for r in got) == by_text(without_strings(rows, 3))


def test_components(docs, texts):
    got = [tuple(r) for r in jaccard.similar_documents(docs).collect()]
    assert by_text(got) == by_text(components(texts))


@pytest.mark.parametrize("size, percent", [(5, 80), (1, 60)])
def test_other_thresholds(docs, texts, size, percent):
    got = [tuple(r) for r in jaccard.similar_documents(docs, size, percent).collect()]
    assert by_text(got) == by_text(components(texts, size, percent))


def test_clusters_in_blocks(docs, texts, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ITEMS", 150)
    got = [tuple(r) for r in jaccard.similar_documents(docs).collect()]
    assert by_text(got) == by_text(components(texts))


def test_common_passages_tie_no_documents(spark, monkeypatch):
    """Each document shares one half with the one before and the other half with the next; only copies are tied."""
    passages = [" ".join(f"p{i}w{j}" for j in range(100)) for i in range(201)]
    rows = [(i, f"{passages[i]} {passages[i + 1]}") for i in range(200)]
    rows += [(1000 + i, f"{rows[i][1]} x{i}") for i in range(0, 200, 10)]
    edges, found = {}, jaccard.connected_components

    def counted(df, scratch, name):
        edges[name] = df.filter("a <> b").distinct().count()
        return found(df, scratch, name)
    monkeypatch.setattr(jaccard, "connected_components", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in jaccard.similar_documents(docs).collect()]
    assert by_text(got) == by_text(components(rows))
    assert edges == {"clusters": 20, "links": 20}


@pytest.mark.parametrize("percent", [86, 90, 95])
def test_near_copies_of_all_sizes(spark, percent):
    rng = random.Random(percent)
    rows = []
    for n in [*range(1, 60), *range(60, 400, 17)]:
        words = [f"w{rng.randrange(40)}" for _ in range(n)]
        for k in range(4):
            at, copy = rng.randrange(n), words[:]
            copy[at:at + k // 2] = [f"x{rng.randrange(9)}" for _ in range(rng.randrange(k + 1))]
            rows.append((len(rows), " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in jaccard.similar_documents(docs, 3, percent).collect()]
    assert by_text(got) == by_text(components(rows, 3, percent))
    assert 0 < sum(c < i for i, _, c in got) < len(rows) / 2


@pytest.mark.parametrize("percent", [60, 80, 86, 90, 97])
def test_similar_sets_share_the_marks_they_need(percent):
    rng = np.random.default_rng(percent)
    for _ in range(1000):
        n = int(np.exp(rng.uniform(0, 7)))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        gone = int(rng.integers(0, n * (100 - percent) // 100 + 1))
        new = int(rng.integers(0, max(0, 100 * (n - gone) // percent - n) + 1))
        b = np.unique(np.r_[rng.choice(a, n - gone, replace=False), rng.integers(0, 2**64, new, dtype=np.uint64)])
        of_a, of_b = ({level: (need, set(items.tolist())) for level, need, items in jaccard.marks(s, percent)} for s in (a, b))
        assert gone + new == 0 or any(len(of_a[k][1] & of_b[k][1]) >= max(of_a[k][0], of_b[k][0])
                                      for k in of_a.keys() & of_b.keys())


@pytest.mark.parametrize("operator", [phrases.removed_passages, suffixes.without_repeats, jaccard.similar_documents])
def test_no_documents(spark, operator):
    assert operator(empty_documents(spark)).collect() == []


def test_prefix_tree_against_all_pairs():
    import numpy as np
    rng = np.random.default_rng(3)
    base = rng.choice(1000, 60, replace=False)
    sets = [np.unique(np.r_[rng.choice(base, 50, replace=False), rng.choice(1000, rng.integers(0, 6))]).astype(np.uint64)
            for _ in range(60)] + [np.array([1], np.uint64), np.array([1, 2], np.uint64)]
    tree = PrefixTree(sets)
    got = {(int(tree.order[a]), int(tree.order[b])) for a, bs in tree.similar(75) for b in bs}
    want = {(a, b) for a in range(len(sets)) for b in range(len(sets))
            if 100 * len(s := set(sets[a]) & set(sets[b])) >= 75 * (len(sets[a]) + len(sets[b]) - len(s))}
    assert got == want and len(want) > len(sets)

    def parts(pairs):
        label = list(range(len(sets)))
        for a, b in pairs:
            label = [label[b] if x == label[a] else x for x in label]
        return {frozenset(i for i in range(len(sets)) if label[i] == x) for x in label}
    tied = forest(tree, 75)
    assert parts(tied) == parts(want) and len(tied) == len(sets) - len(parts(want))
    assert all(a == min(next(p for p in parts(want) if b in p)) for a, b in tied)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (200, 201), (201, 200)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, connected_components(df, Scratch(spark, "t"), "c").collect()))
    assert got == {**dict.fromkeys(range(21), 0), **dict.fromkeys(range(100, 150), 100), 200: 200, 201: 200}


def test_long_texts_give_the_same_words(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from quillvec.llm import words as W
    text = " ".join(f"wörd{i}" for i in range(5000)) + " " + "y" * 9000 + "\ttail"
    whole = [Words(d, o) for _, _, d, o in text_slices(pa.array([text, None, "a b"]))]
    monkeypatch.setattr(W, "SEGMENT", 1000)
    cut = [Words(d, o) for _, _, d, o in text_slices(pa.array([text, None, "a b"]), 1000)]
    assert np.concatenate([w.hashes for w in cut]).tolist() == np.concatenate([w.hashes for w in whole]).tolist()
    assert sum((w.counts.tolist() for w in cut), []) == [5002, 0, 2]
