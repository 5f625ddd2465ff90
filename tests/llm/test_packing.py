"""Packs of histograms and of whole tables: every id once, in sequences without padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SMALL
from plain import empty_documents, odd_documents
from quillvec.llm import byte_ids, packing
from quillvec.llm.bpe import SHAPE
from quillvec.llm.queries import BYTE_BPE, QUERIES


def laid(histogram, length):
    """Every document's pieces, checked: (rest, rank) -> pieces, and fill of each sequence."""
    found = packing.Directions(packing.packed(histogram, length))
    fills = defaultdict(list)
    for rest, count in histogram.items():
        for rank in range(count):
            pieces = found.of(rest, rank)
            assert [p[0] for p in pieces] == [0, *np.cumsum([p[1] for p in pieces]).tolist()[:-1]]
            assert sum(p[1] for p in pieces) == rest
            for _, size, sequence, at in pieces:
                fills[sequence].append((at, size))
    assert sorted(fills) == list(range(found.sequences))
    return fills


@pytest.mark.parametrize("length", [16, 20, 1024])
def test_histograms(length):
    rng = random.Random(length)
    cases = [{}, {1: 1}, {length - 1: 1}, {length // 2 + 1: 7}, {1: 5 * length + 3}, {length - 1: 50}]
    cases += [{rng.randint(1, length - 1): rng.randint(1, 30) for _ in range(rng.randint(1, 60))} for _ in range(40)]
    for histogram in cases:
        fills = laid(histogram, length)
        sizes = []
        for pieces in fills.values():
            at = 0
            for offset, size in sorted(pieces):
                assert offset == at
                at += size
            sizes.append(at)
        short = [s for s in sizes if s != length]
        assert all(s & (s - 1) == 0 for s in short)


def test_patterns_do_not_grow_with_documents():
    rng = random.Random(2)
    histogram = {r: rng.randint(1, 50) for r in range(1, 1024)}
    few = packing.packed(histogram)
    many = packing.packed({r: n * 10**9 + rng.randint(0, 10**6) for r, n in histogram.items()})
    assert sum(len(p.pieces) for p in many) < 100_000
    assert len(many) < 4 * len(few)


def check(rows, texts):
    """Rows of pieces with ids, against the tokenizer."""
    tool = Tokenizer.from_file(BYTE_BPE)
    sequences, whole = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length))
        whole[r.doc_id].append((r.start, r.ids, r.doc_tokens))
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= 1024 and (at == 1024 or at & (at - 1) == 0)
    assert sorted(sequences) == list(range(len(sequences)))
    assert set(whole) == set(texts)
    for doc, text in texts.items():
        ids = [*tool.encode(text or "", add_special_tokens=False).ids, 0]
        assert sum((p[1] for p in sorted(whole[doc])), []) == ids and {p[2] for p in whole[doc]} == {len(ids)}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(7)
    rows = packing.pack(docs, BYTE_BPE).collect()
    check(rows, {r.doc_id: r.text for r in docs.collect()})
    query = QUERIES["op12_packing"](spark, SMALL)
    assert query.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert query.agg(F.sum("length")).first()[0] == sum(r.length for r in rows)


def test_odd_documents(spark):
    odd = odd_documents(spark).withColumn("place", F.lit("x")).withColumn("part", F.lit("y")).withColumn("ids", F.lit(0))
    numbered = odd.withColumn("doc_id", F.monotonically_increasing_id()).cache()
    special = spark.createDataFrame([(10**12, "one <|endoftext|> two")], "doc_id long, text string")
    both = numbered.unionByName(special, allowMissingColumns=True)
    rows = packing.pack(both, BYTE_BPE).collect()
    check(rows, {r.doc_id: r.text for r in both.collect()})
    # Repeated ids and NULL ones: each row is a document.
    out = packing.pack(odd, BYTE_BPE, ids=False)
    assert out.filter("start = 0").count() == odd.count()
    assert out.filter("doc_id IS NULL AND start = 0").count() == 2


def test_places_beyond_the_broadcast(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(5).cache()
    sent = packing.pack(docs, BYTE_BPE).collect()
    monkeypatch.setattr(packing, "PARTS_SENT", 1)
    assert sorted(map(str, packing.pack(docs, BYTE_BPE).collect())) == sorted(map(str, sent))


def test_no_documents(spark):
    assert packing.pack(empty_documents(spark), BYTE_BPE).collect() == []


def test_remembered_pieces_give_the_same_ids():
    random.seed(4)
    some = ["=", "-", " ", "\n", "\t", "a", "ab", "é", "ñ", "  ", "...", "*", "_", "00", "1", "ha", "\r\n", "😀", "中",
            "　", "\x85", "\x1f", "'s", "'ll", "'", "²", "Ⅷ", "ǅ", "ß", "́", "<|endoftext|>", "“", "€", "ª", "\0", "\xad"]
    texts = ["".join(random.choices(random.sample(some, random.choice([1, 2, 3, len(some)])), k=random.randint(0, 50)))
             for _ in range(3000)]
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        file = f.read()
    tool = Tokenizer.from_file(BYTE_BPE)
    for special in (True, False):
        tool.encode_special_tokens = not special
        mine = byte_ids.ByteIds(file, special)
        ids, at = mine.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] \
            == [tool.encode(t, add_special_tokens=False).ids for t in texts]
    table = mine.token_bytes()
    assert all(b"".join(table[i] for i in ids[a:b].tolist()) == t.encode()
               for t, a, b in zip(texts, at, at[1:], strict=False))


def test_new_pieces_go_to_the_library_in_one_text():
    with open(BYTE_BPE, "rb") as f:
        file = f.read()
    plain, mine = Tokenizer.from_str(file.decode()), byte_ids.ByteIds(file, True)
    letters = str.maketrans("0123456789", "abcdefghij")
    texts = ["", "One two, two (three) 'four' it's 1234 _x\n\nfive  six ", " ".join("w" + str(i * 7919).translate(letters) for i in range(500)), "No space"]

    class Counting:
        sent = 0

        def encode_batch_fast(self, some, **options):
            self.sent += len(some)
            return plain.encode_batch_fast(some, **options)

    mine.tokenizer = Counting()
    ids, at = mine.encode(texts)
    for text, lo, hi in zip(texts, at.tolist()[:-1], at.tolist()[1:], strict=True):
        assert ids[lo:hi].tolist() == plain.encode(text, add_special_tokens=False).ids
    assert mine.tokenizer.sent < 100  # of over 500 pieces
    assert mine.encode([])[1].tolist() == [0] and mine.encode(["One"])[0].tolist() == plain.encode("One").ids


def test_equal_pieces_are_looked_up_once_a_batch():
    with open(BYTE_BPE, "rb") as f:
        mine = byte_ids.ByteIds(f.read(), True)

    class Counting(byte_ids.Numbers):
        asked = 0

        def __getitem__(self, piece):
            self.asked += 1
            return super().__getitem__(piece) if piece in self else self.__missing__(piece)

    mine.known = Counting()
    texts = ["one two three's one", " two", "", "one two\n"] * 500
    ids, at = mine.encode(texts)
    plain = Tokenizer.from_file(BYTE_BPE)
    assert [ids[a:b].tolist() for a, b in zip(at[:5], at[1:5], strict=False)] == [plain.encode(t).ids for t in texts[:4]]
    assert mine.known.asked < 10  # of 4,500 pieces


def test_pieces_are_cut_as_by_the_pattern():
    pattern = regex.compile(SHAPE.replace("LETTER", r"\p{L}").replace("NUMBER", r"\p{N}").replace("OTHER", r"[^\s\p{L}\p{N}]"))
    rng = random.Random(5)
    some = ["'", " ", "s", "t", "re", "ve", "m", "ll", "d", "l", "S", "\n", "\t", "1", "-", "_", "é", "“"]
    texts = ["", "'", " ", "it's 's", "'s't", "  a", "\n\na ", *["".join(rng.choices(some, k=rng.randint(0, 20))) for _ in range(2000)]]
    codes, kind, ends = byte_ids._kinds(texts)
    cut = np.split(codes, byte_ids._starts(codes, kind, ends)[1:])
    assert ["".join(map(chr, p)) for p in cut] == [p for t in texts for p in [*pattern.findall(t), "\0"]]


def test_known_pieces_take_little_memory_and_stay_known():
    with open(BYTE_BPE, "rb") as f:
        mine = byte_ids.ByteIds(f.read(), True)
    letters = str.maketrans("0123456789", "abcdefghij")
    texts = [" ".join("word" + str(i * 7919).translate(letters) for i in range(k, k + 1000)) for k in range(0, 100_000, 1000)]
    ids, at = mine.encode(texts)
    assert len(mine.known) > 100_000
    # Objects in a dictionary of Python's take several times as much.
    assert mine.known.pieces.nbytes < 40 * len(mine.known)

    class Counting:
        sent = 0

        def encode_batch_fast(self, some, **options):
            self.sent += len(some)
            return plain.encode_batch_fast(some, **options)

    plain, mine.tokenizer = mine.tokenizer, Counting()
    again, places = mine.encode(["", *reversed(texts)])
    assert mine.tokenizer.sent == 0
    assert [again[a:b].tolist() for a, b in zip(places[1:-1], places[2:], strict=True)] \
        == [ids[a:b].tolist() for a, b in reversed(list(zip(at[:-1], at[1:], strict=True)))]
    assert ids[:at[1]].tolist() == plain.encode(texts[0]).ids


@pytest.mark.parametrize("end, width", [(0, 2), (50_256, 2), (70_000, 4), (-1, 4)])
def test_ids_are_kept_as_bytes(spark, end, width):
    docs = spark.createDataFrame([(1, "one two " * 800), (2, None), (3, "three"), (None, "caf\u00e9 \u4e2d")],
                                 "doc_id long, text string")
    encoded = packing._encoded(docs, BYTE_BPE, 1024, end, ("doc_id",))
    assert dict(encoded.dtypes)["ids"] == "binary"
    assert all(len(r.ids) == width * r.n for r in encoded.collect())
    tool, found = Tokenizer.from_file(BYTE_BPE), defaultdict(list)
    for r in packing.pack(docs, BYTE_BPE, end=end).collect():
        assert zlib.crc32(np.array(r.ids, np.int32).tobytes()) == r.ids_crc32
        found[r.doc_id].append((r.start, r.ids))
    for r in docs.collect():
        assert sum((x for _, x in sorted(found[r.doc_id])), []) == [*tool.encode(r.text or "").ids, end]
