"""Tokens, the quality network, and the whole pipeline."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from plain import components, empty_documents, odd_documents, without_passages
from quillvec.llm import bpe, quality
from quillvec.llm.queries import ORACLES, PATTERN, QUERIES, RANKS


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.parse_ranks(f.read()), special_tokens={})


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as f:
        return bpe.codec(f.read(), PATTERN)


@pytest.fixture(scope="module")
def docs(spark):
    return odd_documents(spark, spark.read.parquet(f"{SMALL}/documents.parquet")).cache()


def test_ids_of_random_strings(codec, reference):
    random.seed(4)
    some = ["=", "-", " ", "\n", "\t", "a", "ab", "é", "ñ", "  ", "...", "*", "_", "00", "1", "ha", "\r\n", "😀", "中",
            "\u3000", "\x85", "\x1f", "'s", "'ll", "²", "Ⅷ", "ǅ", "ß", "́", "<|endoftext|>"]
    texts = ["".join(random.choices(random.sample(some, random.choice([1, 2, 3, len(some)])), k=random.randint(0, 50)))
             for _ in range(3000)]
    ids, at = codec.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [reference.encode_ordinary(t) for t in texts]


def test_other_patterns_are_spelled_out(codec):
    import re
    import regex
    pattern = r"\p{Lu}+|[^\s\p{N}]|\s+(?!\S)|\p{N}{1,3}"
    text = "ABc ÀÉx 12345 ٣٤٥ ²  \n end\x85.\u3000"
    assert re.findall(bpe.spelled_out(pattern), text) == regex.findall(pattern, text)


def test_texts_come_back(docs, reference):
    ids = bpe.encode(docs, RANKS, PATTERN, ("doc_id", "text"))
    rows = bpe.decode(ids, RANKS, PATTERN, ("doc_id", "text", "ids", "ends")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = r.text or ""
        assert list(r.ids) == reference.encode_ordinary(text) and bytes(r.decoded) == text.encode()
        begun, ends = 0, []
        for i in r.ids:
            begun += sum((b & 0xC0) != 0x80 for b in reference.decode_single_token_bytes(i))
            ends.append(begun)
        assert list(r.ends) == ends


def test_part_of_the_ids(spark):
    docs = spark.createDataFrame([(1, "中😀")], "doc_id long, text string")
    one = bpe.encode(docs, RANKS, PATTERN).select("doc_id", F.slice("ids", 1, 1).alias("ids"))
    got = bytes(bpe.decode(one, RANKS, PATTERN).first().decoded)
    assert got and "中😀".encode().startswith(got)
    none = one.select("doc_id", F.lit(None).cast("array<int>").alias("ids"))
    assert bytes(bpe.decode(none, RANKS, PATTERN).first().decoded) == b""


def test_digests_of_the_query(spark, reference):
    rows = {r.doc_id: r for r in QUERIES["op9_byte_bpe"](spark, SMALL).collect()}
    for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = reference.encode_ordinary(d.text)
        r = rows[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


def test_no_texts_to_encode(spark):
    assert bpe.decode(bpe.encode(empty_documents(spark), RANKS, PATTERN), RANKS, PATTERN).count() == 0


def test_chunks_cover_the_text():
    for n in (0, 1, 511, 512, 513, 640, 641, 5000):
        data = (np.arange(n) % 251).astype(np.uint8)
        starts = quality.chunk_starts(n)
        chunks = quality.chunks_of(data, starts, np.full(len(starts), n))
        seen = {int(s) + i for s, row in zip(starts, chunks, strict=True) for i, b in enumerate(row) if b != quality.PADDING}
        assert seen == set(range(n))
        assert all(row[i] == data[s + i] for s, row in zip(starts, chunks, strict=True)
                   for i in range(quality.CHUNK) if s + i < n)


def test_gradients_are_slopes():
    rng = np.random.default_rng(0)
    network = quality.Network(1)
    network.end[:] = rng.normal(0, 1, network.end.shape)
    chunks = rng.integers(0, 256, (5, quality.CHUNK)).astype(np.int16)
    first, labels, weights = np.array([0, 2, 3]), np.array([1, 0, 1], np.float32), np.ones(3, np.float32)

    def loss():
        p = network.probability(network.pooled(network.answers(chunks)[0], first)).astype(float)
        return -np.mean(weights * np.where(labels > 0, np.log(p), np.log(1 - p)))
    for part, grad in zip(network.parts, network.gradients(chunks, first, labels, weights), strict=True):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        old = part[at]
        part[at] = old + 1e-3
        up = loss()
        part[at] = old - 1e-3
        down = loss()
        part[at] = old
        assert (up - down) / 2e-3 == pytest.approx(float(grad[at]), rel=0.05, abs=1e-4)


@pytest.mark.parametrize("sf, good, bad", [("0.1", 0.95, 0.8), ("0.01", 0.9, 0.5)])
def test_held_out_accuracy(spark, sf, good, bad):
    sf = SMALL.replace("0.001", sf)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op10_quality_classifier"](spark, sf).collect() if r.held_out and labels.get(r.doc_id) is not None]
    right = {q: np.mean([r.predicted == q for r in rows if labels[r.doc_id] == q]) for q in (0, 1)}
    assert right[1] > good and right[0] > bad
    share = np.mean([labels[r.doc_id] for r in rows])
    assert np.mean([r.predicted == labels[r.doc_id] for r in rows]) > max(share, 1 - share)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_draws_hold_all_chunks():
    for n in (1, 6, 7, 20, 48):
        starts = np.arange(n)
        assert set(np.concatenate([quality.drawn(starts, k) for k in range(quality.DRAWS)])) == set(range(n))
    draws = [quality.drawn(np.arange(1000), k) for k in range(quality.DRAWS)]
    assert all(len(d) == quality.DRAW_CHUNKS for d in draws) and len(set(np.concatenate(draws))) == 48
    chunks = quality.chunks_of(np.arange(700).astype(np.uint8), np.array([0, 384]), np.array([700, 700]))
    assert (quality._padded(quality._packed(chunks)) == chunks).all()


def test_scores_are_those_of_a_plain_convolution():
    """Filters over embedded bytes, place by place, for each chunk and text."""
    network = quality.Network(4)
    rng = np.random.default_rng(2)
    network.end[:] = rng.normal(0, 1, network.end.shape)
    network.shift[:] = rng.normal(0, 0.1, network.shift.shape)
    texts = [b"", b"abc", bytes(rng.integers(32, 127, 1300).astype(np.uint8))]
    got = quality.text_scores(network, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    for text, score in zip(texts, got, strict=True):
        answers = []
        for start in range(0, max(1, len(text) - (quality.CHUNK - quality.HOP)), quality.HOP):
            chunk = list(text[start:start + quality.CHUNK])
            chunk += [quality.PADDING] * (quality.CHUNK - len(chunk))
            answers.append([max(0, max(float(network.embedding[chunk[p:p + quality.WIDTH]].ravel() @ network.filters[:, f])
                                       for p in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE)) + network.shift[f])
                            for f in range(quality.FILTERS)])
        pooled = np.r_[np.max(answers, axis=0), np.mean(answers, axis=0)]
        assert score == pytest.approx(1 / (1 + np.exp(-(pooled @ network.end + network.bias[0]))), abs=1e-5)


def test_scores_of_odd_texts(docs):
    network = quality.fit([])
    rows = quality.quality_scores(docs, network).collect()
    assert len(rows) == docs.count() and all(r.score == 0.5 for r in rows)
    trained = quality.Network(2)
    trained.end[:] = 0.3
    by_text = {}
    for r, d in zip(sorted(quality.quality_scores(docs.filter("doc_id < 100"), trained).collect(), key=lambda r: r.doc_id),
                    sorted(docs.filter("doc_id < 100").collect(), key=lambda r: r.doc_id), strict=True):
        by_text.setdefault(d.text or "", set()).add(r.doc_id)
    assert quality.quality_scores(docs.limit(0), trained).count() == 0


def test_long_texts_score_as_their_chunks():
    network = quality.Network(3)
    network.end[:] = np.random.default_rng(1).normal(0, 1, network.end.shape)
    texts = ["a" * 3, "", "xyz " * 400_000, "b c"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *[len(t) for t in texts]])
    whole = quality.text_scores(network, data, offsets)
    alone = [quality.text_scores(network, np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert whole == pytest.approx(alone, abs=1e-6)


def test_stages_hold_their_promises(spark, docs):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    kept = corpus_pipeline.quality_rules(spark, docs, SMALL).cache()
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert kept.exceptAll(docs).count() == 0

    apart = corpus_pipeline.near_duplicates(spark, kept, SMALL).cache()
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    want = [(d, t) for (d, t), (_, _, c) in zip(rows, components(rows, 5, 80), strict=True) if d is None or c == d]
    assert sorted(map(tuple, apart.select("doc_id", "text").collect()), key=repr) == sorted(want, key=repr)

    cut = corpus_pipeline.substring_dedup(spark, apart, SMALL).cache()
    plain = without_passages([(r.doc_id, r.text) for r in apart.collect()])
    assert sorted(((r.doc_id, " ".join((r.text or "").encode().decode().split())) for r in cut.collect()), key=repr) \
        == sorted(((d, " ".join(rest.split())) for d, _, _, rest in plain), key=repr)
    assert cut.columns == docs.columns and all(r.n_chars == (None if r.text is None else len(r.text)) for r in cut.collect())

    clean = corpus_pipeline.decontamination(spark, cut, SMALL)
    assert clean.columns == docs.columns and clean.exceptAll(cut).count() == 0
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert not [1 for r in clean.collect() for i in items if r.text and i in r.text]
    assert set(columns) <= set(clean.columns)

    tokens = corpus_pipeline.token_ids(spark, clean, SMALL)
    assert tokens.count() == clean.count()


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "substring_dedup", "decontamination", "token_ids"]
    out = corpus_pipeline.run(spark, SMALL)
    n = out.count()
    assert 0 < n < spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_stages_without_rows(spark):
    docs = empty_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


@pytest.mark.parametrize("name", list(ORACLES))
def test_oracles(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    result = con.execute(ORACLES[name])
    at = [[d[0] for d in result.description].index(c) for c in columns]
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert got == sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=repr)


def test_flat_arrays_of_null_lists():
    from quillvec.llm.tables import lists
    kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
    at, fields = lists(pa.array([None, [{"lo": 1, "hi": 2}], [], [{"lo": 3, "hi": 4}, {"lo": 5, "hi": 6}]], kind))
    assert at.tolist() == [0, 0, 1, 1, 3] and fields["lo"].tolist() == [1, 3, 5]
