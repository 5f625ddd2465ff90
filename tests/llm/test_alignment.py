"""Two tokenizers side by side, against a loop over all pairs of tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SMALL
from plain import empty_documents, odd_documents
from quillvec.llm import alignment
from quillvec.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    from quillvec.llm.bpe import byte_characters
    byte = {c: i for i, c in enumerate(byte_characters())}
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    return a, b, byte


def tokens(tools, text):
    a, b, byte = tools
    if not text:
        return [], []
    left = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode())
             for i, p in ((i, b.id_to_piece(i)) for i in b.encode(text))]
    whole = (" " + text).encode()
    if any(b"".join(t for _, t in side) != whole for side in (left, right)):
        return [], []
    return left, right


def plain(tools, texts):
    """The columns of each text."""
    out, counts, every = [], Counter(), []
    for text in texts:
        spans = []
        for side in tokens(tools, text):
            at, found = 0, []
            for i, t in side:
                found.append((i, at, at + len(t)))
                at += len(t)
            spans.append(found)
        left, right = spans
        links, near = [], 0
        for i, lo, hi in left:
            while right[near][2] <= lo:
                near += 1
            k = near
            while k < len(right) and right[k][1] < hi:
                links.append((i, right[k][0]))
                k += 1
        counts.update(links)
        ends = sorted({x[2] for x in left} & {x[2] for x in right})
        groups, begin = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, lo, hi in side if begin <= lo and hi <= end) for side in spans)
                          if len(ends) < 500 else "")
            begin = end
        every.append((left, right, ends, links, groups))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for left, right, ends, links, groups in every:
        out.append((len(left), len(right), len(ends), len(links), sum(counts[x] == most[x[1]] for x in links),
                    sum(counts[x] for x in links),
                    "" if not left else hashlib.sha256(";".join(groups).encode()).hexdigest() if len(ends) < 500 else None))
    return out


def same(rows, expected):
    assert len(rows) == len(expected)
    for r, e in zip(rows, expected, strict=True):
        assert tuple(r[c] for c in COLUMNS[:-1]) == e[:-1]
        assert e[-1] is None or r.groups_sha256 == e[-1]


def test_query_equals_plain(spark, tools):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    out = QUERIES["op13_tokenizer_alignment"](spark, SMALL)
    assert out.columns == ["doc_id", *COLUMNS]
    same(out.orderBy("doc_id").collect(), plain(tools, [d.text for d in docs]))


def test_odd_texts_in_many_blocks(spark, tools, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 3000)
    monkeypatch.setattr(alignment, "COUNTS_SENT", 1)
    random.seed(8)
    some = ["=", " ", "\n", "\t", "a", "ab", "é", "  ", "    ", "...", "00", "ha", "\r\n", "😀", "中", "　", "\x85",
            "'ll", "▁", "<s>", "<0x41>", "<|endoftext|>", "<unk>", "ﬁ", "é", "\0"]
    texts = ["".join(random.choices(some, k=random.randint(1, 40))) for _ in range(200)]
    odd = odd_documents(spark).withColumns({"block": F.lit("x"), "at": F.lit(1), "pairs": F.lit("p"), "links": F.lit(0)})
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    both = odd.unionByName(more, allowMissingColumns=True).withColumn("nr", F.monotonically_increasing_id()) \
        .repartition(4).cache()
    rows = alignment.aligned(both, BYTE_BPE, PIECE_BPE, ("nr", "doc_id")).orderBy("nr").collect()
    given = both.orderBy("nr").collect()
    same(rows, plain(tools, [d.text for d in given]))
    assert [r.doc_id for r in rows] == [d.doc_id for d in given]
    assert any(d.text and not r.n_a for r, d in zip(rows, given, strict=True))  # bytes that don't come back


def test_detail(spark, tools):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(20)
    for r in alignment.aligned(docs, BYTE_BPE, PIECE_BPE, ("doc_id", "text"), detail=True).collect():
        left, right = tokens(tools, r.text)
        assert r.a_ids == [i for i, _ in left] and r.b_ids == [i for i, _ in right]
        ends = [np.cumsum([len(t) for _, t in side]) for side in (left, right)]
        assert r.cuts == sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
        want = {(i, j) for i in range(len(left)) for j in range(len(right))
                if max(ends[0][i] - len(left[i][1]), ends[1][j] - len(right[j][1])) < min(ends[0][i], ends[1][j])} \
            if len(left) < 800 else None
        assert want is None or {(x.a, x.b) for x in r.links} == want
        assert len({(x.a, x.b) for x in r.links}) == len(r.links) == r.n_links


@pytest.mark.parametrize("lane", [1, 2, 7, 1000])
def test_places_of_long_texts_do_not_matter(lane):
    rng = random.Random(lane)
    for _ in range(50):
        sizes = [rng.randint(0, 60) for _ in range(rng.randint(1, 5))]
        def cut():
            ends, at, base = [], [0], 0
            for size in sizes:
                ends += [base + e for e in sorted({*rng.sample(range(1, size + 1), rng.randint(0, size)), size} - {0})]
                at.append(len(ends))
                base += size
            return np.array(ends, np.int64), np.array(at)
        (a, at), (b, _) = cut(), cut()
        link_a, link_b, cut_a, cut_b = alignment.lockstep(a, b, at, lane)
        begin_a, begin_b = np.r_[0, a[:-1]], np.r_[0, b[:-1]]
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(begin_a[i], begin_b[j]) < min(a[i], b[j])]
        assert list(zip(link_a.tolist(), link_b.tolist(), strict=True)) == want
        assert a[cut_a].tolist() == b[cut_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_no_documents(spark):
    assert alignment.aligned(empty_documents(spark), BYTE_BPE, PIECE_BPE).collect() == []
