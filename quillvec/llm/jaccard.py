"""Similarity join on word n-grams by prefix trees, and the components of its links.

1. A document's set of shingles is hashed; equal sets are one class from here on.
2. The range of hashes is cut into parts, more for larger sets. Each shingle that only one of two sets has spoils one
   part, and of similar sets these are few, so that they agree on many whole parts. Counts of the parts show which are
   shared, and a set with too few shared ones has no partner; common passages alone don't give it enough. Of the others
   the rarest shared ones suffice: similar sets have one of them in common. Sets tied by such parts form a cluster.
   Where parts can't be sure to do, as in some small sets, the first shingles in the order of hashes stand in for them.
3. Each set travels to the task of its cluster once. There a prefix tree holds the sets in one order, and all sets
   descend it together, with overlaps counted once for shared paths and subtrees left by the bound on what remains.
   A cluster beyond ``BLOCK_ITEMS`` is cut into blocks, and each pair of blocks has a tree of its own.
4. Links that connect what all links connect go on, and components of links are taken.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvec.llm.components import connected_components
from quillvec.llm.prefix_tree import PrefixTree, forest
from quillvec.llm.tables import Scratch, arrays, signed, spread
from quillvec.llm.words import Words, grams, mix, text_column, text_slices

SHINGLE = 3
PERCENT = 90
#: Items of a cluster that one block holds.
BLOCK_ITEMS = 2_000_000
#: Ids above this stand for documents without one.
NAMELESS = 2**62


def similar_documents(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row of ``docs``.

    Two documents are linked if ``100 * intersection >= percent * union`` for their sets of shingles, with A-Z in
    lower case; a document with fewer words than a shingle has its whole sequence of words as its only one.
    ``component_id`` is the smallest ``doc_id`` that links lead to, the document's own included.

    A NULL or empty text has an empty set, is linked with nothing and keeps its own id. A NULL ``doc_id`` takes
    part; its component is NULL if no document with an id belongs to it. Rows with one id are taken as one document if
    they are the first of their sets. Repeated rows all come back. Other columns are left out.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    sets = scratch.keep(_sets(docs, shingle, percent), "sets")
    classes = scratch.keep(sets.filter("n > 0").groupBy("c1", "c2").agg(
        F.min("id").alias("node"), F.min("n").alias("n")), "classes")
    tied = _tied(sets, classes, scratch)
    cluster = connected_components(tied, scratch, "clusters")
    component = connected_components(_links(docs, classes, cluster, shingle, percent), scratch, "links")
    by_class = classes.join(component, "node", "left").select(
        "c1", "c2", F.coalesce("component", "node").alias("component"))
    own = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("component") < NAMELESS, F.col("component"))
    return sets.join(by_class, ["c1", "c2"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def _shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The set of each text as sorted hashes."""
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    words = Words(lower, offsets)
    gram = grams(words.hashes, size)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(gram[a:b - size + 1]))
        else:
            out.append(grams(words.hashes[a:b], b - a) if b > a else gram[:0])
    return out


def shared_at_least(n, percent: int):
    """Of the first shingles of a set of ``n``, so many are shared with any similar set as large."""
    return np.maximum(1, n * (100 - percent) // 200)


def prefix_length(n, percent: int):
    return n - -(-n * percent // 100) + shared_at_least(n, percent)


def most_apart(n, percent: int):
    """Shingles that only one of two similar sets has, at most, if one of them has ``n``."""
    return n * (100 - percent) // percent


@lru_cache
def levels(percent: int) -> tuple[list[int], list[int], int]:
    """Smallest set of each level, its number of parts, and how many shingles a part must have to be a mark.

    A part of the smallest sets of a level has ``mean`` shingles, and there are 9 parts for 4 shingles that may differ.
    Below 86 percent a mark would be a single shingle, as first shingles are, and there are no levels.
    """
    mean = percent / (100 - percent) * 4 / 9 if percent < 100 else 0
    least, below = 0, math.exp(-mean)
    while below <= 0.25:  # of parts with so few shingles or less
        least += 1
        below += math.exp(-mean) * mean ** least / math.factorial(least)
    if least < 2:
        return [], [], 0
    first = [-(-percent // (100 - percent))]
    while first[-1] < 2**31:
        first.append(first[-1] * 3 // 2 + 1)
    return first, [math.ceil(n / mean) for n in first], least


def marks(s: np.ndarray, percent: int) -> list[tuple[int, int, np.ndarray]]:
    """``(level, need, items)`` of a sorted set: a similar set of the same level has ``need`` of the items as well.

    A set has the marks of its own level and, since the larger one of two decides, of that of the largest similar set.
    A mark is a part with enough shingles, by all of them. Each shingle that only one of two sets has spoils the part it
    falls into, so similar sets share all marks of either one but as many as shingles are apart. Each of the two may drop
    its ``need - 1`` most frequent shared marks: the rarest mark that both have stays with both.
    Level 0 holds first shingles; they count for two sets that both have some, which are those where the parts of a
    level are fewer than those that may be spoilt. A set that is similar to equal ones only has none.
    """
    n = len(s)
    apart = most_apart(n, percent)
    if not apart:
        return []
    first, parts, least = levels(percent)
    own, largest = (bisect_right(first, m) for m in (n, n * 100 // percent))
    out, sure = [], own > 0
    for level in range(own, largest + 1) if sure else ():
        part = (s >> np.uint64(32)) * np.uint64(parts[level - 1]) >> np.uint64(32)
        start = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        full = np.diff(np.r_[start, n]) >= least
        need = int(full.sum()) - apart
        sure &= need > 0
        out.append((level, max(1, need), mix(np.add.reduceat(s, start)[full] ^ mix(np.array([level], np.uint64)))))
    if not sure:
        out.append((0, max(1, -(-n * percent // 100) * (100 - percent) // 200), s[:prefix_length(n, percent)]))
    return out


def _sets(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Per document: size, hash of the whole set in two halves, and its marks; ``kind`` is level and need in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for first, after, data, offsets in text_slices(text_column(batch)):
                found = _shingles(data, offsets, shingle)
                n = np.array([len(s) for s in found], np.int32)
                digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in found), np.int64)
                each = [marks(s, percent) for s in found]
                flat = [m for own in each for m in own]
                items = pa.ListArray.from_arrays(
                    np.r_[0, np.cumsum([len(m[2]) for m in flat])].astype(np.int32),
                    signed(np.concatenate([np.zeros(0, np.uint64), *(m[2] for m in flat)])))
                kinds = pa.array([level << 32 | need for level, need, _ in flat], pa.int64())
                own = pa.ListArray.from_arrays(np.r_[0, np.cumsum([len(m) for m in each])].astype(np.int32),
                                               pa.StructArray.from_arrays([kinds, items], ["kind", "items"]))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, after - first), n, digest[0::2].copy(), digest[1::2].copy(), own],
                    ["doc_id", "n", "c1", "c2", "marks"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n int, c1 long, c2 long, marks array<struct<kind:long,items:array<long>>>")
    nameless = F.lit(NAMELESS) + F.col("c1").bitwiseAND(F.lit(NAMELESS - 1))
    return out.withColumn("id", F.coalesce("doc_id", nameless))


def _tied(sets: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs ``a, b`` of classes, by node, such that similar ones are connected."""
    firsts = sets.join(classes.select("c1", "c2", F.col("node").alias("id")), ["c1", "c2", "id"]) \
        .dropDuplicates(["c1", "c2"]).select(F.col("id").alias("node"), F.explode("marks").alias("marks")) \
        .select("node", "marks.kind", F.explode("marks.items").alias("item"))
    firsts = scratch.keep(firsts, "firsts")
    counts = scratch.keep(firsts.groupBy("item").agg(F.count("*").alias("holders")).filter("holders > 1"), "counts")
    shared = firsts.join(counts, "item").groupBy("node", "kind").agg(
        F.sort_array(F.collect_list(F.struct("holders", "item"))).alias("items")).selectExpr(
        "node", "slice(items, 1, greatest(0, size(items) - int(kind & 4294967295) + 1)) AS items")
    rare = scratch.keep(shared.selectExpr("node AS a", "explode(items.item) AS item"), "rare")
    hubs = scratch.keep(rare.groupBy("item").agg(F.min("a").alias("b")), "hubs")
    scratch.drop("firsts", "counts")
    return rare.join(hubs, "item").select("a", "b").distinct()


def _links(docs: DataFrame, classes: DataFrame, cluster: DataFrame, shingle: int, percent: int) -> DataFrame:
    members = classes.join(cluster, "node").select("node", "c1", "c2", "n", "component")
    parts = members.groupBy("component").agg(F.sum("n").alias("items")) \
        .select("component", spread(F.col("items"), BLOCK_ITEMS).alias("parts"))
    dealt = members.join(parts, "component").withColumn(
        "block", F.expr("IF(parts > 1, pmod(hash(c1), parts), 0)")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).selectExpr(
        "node", "c1", "c2", "component", "block", "least(block, other) AS i", "greatest(block, other) AS j")
    nameless = F.col("doc_id").isNull()
    named = docs.filter(~nameless).select(F.col("doc_id").cast("long").alias("node"), "text")
    wanted = dealt.groupBy("node", "c1", "c2").agg(F.collect_list(F.struct("component", "i", "j", "block")).alias("to"))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, c1, c2 = arrays(batch, "node", "c1", "c2")
            to = batch.column(batch.schema.get_field_index("to"))
            for first, _, data, offsets in text_slices(text_column(batch)):
                rows, found = [], []
                for k, s in enumerate(_shingles(data, offsets, shingle), first):
                    digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                    if (digest[0], digest[1]) == (c1[k], c2[k]):  # else another text with this id
                        rows.append(k)
                        found.append(s.tobytes())
                if rows:
                    yield pa.RecordBatch.from_arrays([nodes[rows], to.take(pa.array(rows)), pa.array(found, pa.binary())],
                                                     ["node", "to", "items"])

    texts = named.join(wanted, "node")
    lost = wanted.filter(F.col("node") >= NAMELESS)
    unnamed = docs.filter(nameless).select(F.xxhash64("text").alias("t"), "text").dropDuplicates(["t", "text"])
    texts = texts.select("node", "c1", "c2", "to", "text").unionByName(
        _unnamed(unnamed, shingle).join(lost, ["c1", "c2"]).select("node", "c1", "c2", "to", "text"))
    target = "array<struct<component:long,i:int,j:int,block:int>>"
    sent = texts.mapInArrow(tokens, f"node long, to {target}, items binary").select(
        "node", "items", F.explode("to").alias("to")).select("node", "items", "to.*").repartition("component", "i", "j") \
        .sortWithinPartitions("component", "i", "j")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in batches:
            columns = (batch.column(batch.schema.get_field_index(c)).to_pylist()
                       for c in ("component", "i", "j", "block", "node", "items"))
            for component, i, j, block, node, items in zip(*columns, strict=True):
                if (component, i, j) != current:
                    yield from _similar(current, rows, percent)
                    current, rows = (component, i, j), []
                rows.append((block, node, np.frombuffer(items, np.uint64)))
        yield from _similar(current, rows, percent)

    return sent.mapInArrow(join, "a long, b long")


def _unnamed(docs: DataFrame, shingle: int) -> DataFrame:
    """Texts without an id, with the hash of their set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch)
            for first, after, data, offsets in text_slices(texts):
                digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes())
                                                for s in _shingles(data, offsets, shingle)), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [digest[0::2].copy(), digest[1::2].copy(), texts.slice(first, after - first)], ["c1", "c2", "text"])

    return docs.select("text").mapInArrow(run, "c1 long, c2 long, text string").dropDuplicates(["c1", "c2"])


def _similar(key, rows, percent: int) -> Iterator[pa.RecordBatch]:
    if len(rows) < 2:
        return
    rows.sort(key=lambda r: r[1])
    nodes = [r[1] for r in rows]
    tree = PrefixTree([r[2] for r in rows])
    queries = None
    if key[1] != key[2]:  # pairs within a block belong to the tree of that block alone
        queries = np.flatnonzero(np.array([rows[k][0] for k in tree.order]) == key[1])
    pairs = forest(tree, percent, queries)
    if pairs:
        yield pa.RecordBatch.from_arrays([np.array([nodes[a] for a, _ in pairs], np.int64),
                                          np.array([nodes[b] for _, b in pairs], np.int64)], ["a", "b"])
