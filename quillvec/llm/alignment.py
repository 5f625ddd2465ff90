"""Alignment of the tokens that two tokenizers make of the same texts.

1. Both tokenizers read a batch of texts. Where the bytes of both are those of the text, all texts of the batch are merged
   in lockstep: one vector holds each text's place among its A tokens, another among its B tokens. In each step every
   text gives a link of the two tokens it stands at, a cut if both end there, and moves on behind the one that ends
   first; finished texts leave the vectors. A long text takes several places in them, each for some of its A tokens.
2. A block of texts lists its distinct pairs of ids once, and each text refers to that list. So what is counted and
   looked up over the corpus is a row for each block and pair, not for each link.
3. Counts of pairs go back to the blocks by a join, and each block is finished by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvec.llm.byte_ids import byte_ids
from quillvec.llm.tables import Scratch
from quillvec.llm.words import text_column, text_slices
from quillvec.storage import sized

#: Bytes of text in a block.
BLOCK = 1 << 21
#: A tokens of one text that one place of the vectors takes.
LANE = 256
#: Counts of pairs that are sent to all tasks; beyond, they are joined by a shuffle.
COUNTS_SENT = 300_000
DETAIL = "a_ids array<int>, b_ids array<int>, cuts array<int>, links array<struct<a:int,b:int>>"


def aligned(docs: DataFrame, a_path: str, b_path: str, carry: tuple[str, ...] = ("doc_id",),
            detail: bool = False) -> DataFrame:
    """Links and groups of the tokens of each text, and how usual its links are in all texts.

    ``a_path`` is a byte-level BPE file, read with a space before the text; ``b_path`` a sentencepiece model that adds that
    space itself. Names of special tokens in a text are plain text. Returns the columns in ``carry``, with ``n_a``,
    ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose pair of ids is the most frequent one of its B id),
    ``count_sum`` (of the frequencies of the links' pairs) and ``groups_sha256`` of the ids by groups. With ``detail`` also
    ``a_ids``, ``b_ids``, ``cuts`` (bytes up to where tokens of both end, the space included) and ``links`` (numbers of
    tokens).

    A text that is NULL or empty, or whose bytes either tokenizer changes, has no tokens: zeros, and no hash. Rows that
    repeat count as often as they come; a NULL ``doc_id`` comes back as NULL. Columns not in ``carry`` are left out, so
    their names don't matter. No documents give no rows.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    blocks = scratch.keep(_blocks(docs, a_path, b_path, carry, detail), "blocks")
    listed = blocks.filter("pairs IS NOT NULL")
    counts = listed.selectExpr("inline(arrays_zip(pairs, totals))").groupBy(F.col("pairs").alias("pair")) \
        .agg(F.sum("totals").alias("n"))
    counts = scratch.keep(counts.select("pair", "n", F.expr("pair & 4294967295").alias("b")), "totals")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    counts = scratch.keep(counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")
    found = listed.selectExpr("block", "posexplode(pairs) AS (at, pair)").join(sized(counts, COUNTS_SENT), "pair") \
        .select(F.col("block").alias("of_block"), F.col("at").alias("place"), "n", "best")
    row = blocks.schema["row"].dataType.simpleString()
    out = f"row {row}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string" \
        + (f", {DETAIL}" if detail else "")
    names = [c.split()[0] for c in out.removeprefix(f"row {row}, ").split(", ")]

    def finish(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        at = pairs["place"].to_numpy()
        count[at], best[at] = pairs["n"].to_numpy(), pairs["best"].to_numpy()
        lists, times = texts["at"].combine_chunks(), texts["times"].combine_chunks().flatten().to_numpy()
        place, lengths = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
        ends = np.cumsum(lengths)

        def summed(values: np.ndarray) -> pa.Array:
            total = np.r_[0, np.cumsum(values * times)]
            return pa.array(total[ends] - total[ends - lengths])

        columns = {"n_best": summed(best[place].astype(np.int64)), "count_sum": summed(count[place])}
        return pa.table({n: columns[n] if n in columns else texts[n] for n in ["row", *names]})

    texts = blocks.filter("pairs IS NULL").drop("pairs", "totals")
    return texts.groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(finish, out).select("row.*", *names)


class Aligner:
    """Both tokenizers, and the bytes and written form of each of their ids."""

    def __init__(self, a_file: bytes, b_file: bytes):
        self.a = byte_ids(a_file, False)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.a_bytes = self.a.token_bytes()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.IsByte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.IdToPiece, range(self.b.GetPieceSize())))]
        self.a_lengths, self.b_lengths = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        # An id and what follows it: within its group, and at the end of it.
        self.a_written, self.b_written = (np.array([f"{i}{s}" for s in (",", end) for i in range(len(x))], object)
                                          for x, end in ((self.a_bytes, "|"), (self.b_bytes, ";")))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B end to end, each with where texts begin; none for texts whose bytes don't come back."""
        ids, at = self.a.encode([f" {t}" if t else "" for t in texts])
        a, b = np.split(ids, at[1:-1]), self.b.encode(texts, num_threads=1)
        for k, text in enumerate(texts):
            whole = b" " + text.encode()
            if not text or b"".join([self.b_bytes[i] for i in b[k]]) != whole \
                    or b"".join([self.a_bytes[i] for i in a[k].tolist()]) != whole:
                a[k], b[k] = ids[:0], []
        b_at = np.r_[0, np.cumsum([len(x) for x in b])]
        return (np.concatenate(a) if a else ids, np.r_[0, np.cumsum([len(x) for x in a])],
                np.fromiter((i for x in b for i in x), np.int32, b_at[-1]), b_at)


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, at: np.ndarray, lane: int = LANE):
    """Links and cuts of many texts whose tokens end at these bytes, all texts end to end.

    ``at`` tells where the A tokens of each text begin. Returns the A and B tokens of links, ordered, and of cuts.
    """
    i = np.concatenate([np.arange(lo, hi, lane) for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                       or [np.zeros(0, np.int64)])
    stop = np.r_[i[1:], at[-1]]
    j = np.searchsorted(b_ends, np.r_[0, a_ends][i], "right")
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(i):
        links_a.append(i)
        links_b.append(j)
        a, b = a_ends[i], b_ends[j]
        both = a == b
        cuts_a.append(i[both])
        cuts_b.append(j[both])
        i, j = i + (a <= b), j + (b <= a)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    none = [np.zeros(0, np.int64)]
    a, b = np.concatenate(links_a or none), np.concatenate(links_b or none)
    order = np.lexsort((b, a))
    return a[order], b[order], np.sort(np.concatenate(cuts_a or none)), np.sort(np.concatenate(cuts_b or none))


_ALIGNERS: dict[str, Aligner] = {}


def _aligner(a_file: bytes, b_file: bytes) -> Aligner:
    key = hashlib.sha256(a_file + b_file).hexdigest()
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(a_file, b_file)
    return _ALIGNERS[key]


def _lists(values: np.ndarray, at: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(at.astype(np.int32), values)


def _blocks(docs: DataFrame, a_path: str, b_path: str, carry: tuple[str, ...], detail: bool) -> DataFrame:
    """A row for each text, with places (``at``) in its block's list of pairs and how often each is linked (``times``);
    and a row for each block with that list (``pairs``) and what its links sum up to (``totals``)."""
    files = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            files.append(f.read())
    files = docs.sparkSession.sparkContext.broadcast(files)  # vocabularies have a fixed size
    source = docs.select(F.struct(*carry).alias("row"), "text")
    row = source.schema["row"].dataType
    schema = (f"block long, row {row.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
              "groups_sha256 string, at array<int>, times array<int>, pairs array<long>, totals array<long>"
              + (f", {DETAIL}" if detail else ""))
    names = [c.split()[0] for c in schema.replace(row.simpleString(), "x").split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _aligner(*files.value)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            rows, texts = batch.column(batch.schema.get_field_index("row")), text_column(batch)
            for first, after, *_ in text_slices(texts, BLOCK):
                own, pairs, totals = _align(tool, [t or "" for t in texts.slice(first, after - first).to_pylist()], detail)
                own["row"] = rows.slice(first, after - first)
                own["block"] = pa.array(np.full(after - first, block))
                yield _batch(own, names, after - first, batch.schema, own)
                yield _batch({"block": pa.array([block]), "pairs": pa.array([pairs]), "totals": pa.array([totals])},
                             names, 1, batch.schema, own)
                block += 1

    return source.mapInArrow(run, schema)


def _batch(given: dict[str, pa.Array], names: list[str], rows: int, schema: pa.Schema, like: dict[str, pa.Array]):
    """A batch with all columns, NULL where none is given."""
    kinds = {"pairs": pa.list_(pa.int64()), "totals": pa.list_(pa.int64()), **{n: x.type for n, x in like.items()}}
    return pa.RecordBatch.from_arrays([given[n] if n in given else pa.nulls(rows, kinds[n]) for n in names], names)


def _align(tool: Aligner, texts: list[str], detail: bool) -> tuple[dict[str, pa.Array], np.ndarray, np.ndarray]:
    a, a_at, b, b_at = tool.encode(texts)
    a_ends, b_ends = np.cumsum(tool.a_lengths[a]), np.cumsum(tool.b_lengths[b])
    link_a, link_b, cut_a, cut_b = lockstep(a_ends, b_ends, a_at)
    n = len(texts)
    link_at, cut_at = np.searchsorted(link_a, a_at), np.searchsorted(cut_a, a_at)
    pairs, which, totals = np.unique(a[link_a].astype(np.int64) << 32 | b[link_b], return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), np.diff(link_at))
    listed, times = np.unique(owner * max(1, len(pairs)) + which, return_counts=True)
    listed_at = np.searchsorted(listed, np.arange(n + 1) * max(1, len(pairs)))
    hashes = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in _written(tool, a, a_at, b, b_at, cut_a, cut_b)]
    own = {"n_a": np.diff(a_at), "n_b": np.diff(b_at), "n_groups": np.diff(cut_at), "n_links": np.diff(link_at)}
    own = {k: pa.array(v.astype(np.int64)) for k, v in own.items()}
    own |= {"groups_sha256": pa.array(hashes, pa.string()),
            "at": _lists((listed % max(1, len(pairs))).astype(np.int32), listed_at),
            "times": _lists(times.astype(np.int32), listed_at)}
    if detail:
        begin = np.r_[0, a_ends][a_at]
        own |= {"a_ids": _lists(a.astype(np.int32), a_at), "b_ids": _lists(b, b_at),
                "cuts": _lists((a_ends[cut_a] - np.repeat(begin[:-1], np.diff(cut_at))).astype(np.int32), cut_at),
                "links": _lists(pa.StructArray.from_arrays(
                    [pa.array((x - at[:-1][owner]).astype(np.int32)) for x, at in ((link_a, a_at), (link_b, b_at))],
                    ["a", "b"]), link_at)}
    return own, pairs, totals


def _written(tool: Aligner, a, a_at, b, b_at, cut_a, cut_b) -> Iterator[str]:
    """Each text's ids by groups: those of A, a bar, those of B, a semicolon between groups."""
    a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_last[cut_a], b_last[cut_b] = 1, 1
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    out = np.empty(len(a) + len(b), object)
    # Before an A token lie the B tokens of earlier groups; before a B token also the A tokens of its own.
    out[np.arange(len(a)) + np.r_[0, cut_b + 1][a_group]] = tool.a_written[a + len(tool.a_bytes) * a_last]
    out[np.arange(len(b)) + (cut_a + 1)[b_group]] = tool.b_written[b + len(tool.b_bytes) * b_last]
    at = (a_at + b_at).tolist()
    for lo, hi in zip(at, at[1:], strict=False):
        yield "".join(out[lo:hi].tolist())[:-1]
