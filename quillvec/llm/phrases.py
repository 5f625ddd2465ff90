"""Removal of passages that an earlier document holds as well.

1. Every window of consecutive words is filed under the smallest hash of the ``ANCHOR``-word phrases in it. Phrases
   found in two documents are the recurring ones; all other windows are unique.
2. Neighbouring windows filed under one place of a phrase are a run. Runs of equal words are one class, with the
   smallest id that holds it, so copies are counted and never compared with each other.
3. Where a phrase has one class, the whole run is the passage, and its places are those of the class. Where it has
   several, the words of one run of each are cut out, and recurring passages are confirmed on them: a class of two
   documents is one, and so are windows that two classes share, which are counted by hash.
4. Passages are compiled into Aho-Corasick automata over words, in shards by phrase, and the classes of that phrase,
   which stand for all documents that can match, are streamed through. A phrase with very many classes is
   dealt out in parts, each with the passages that its classes hold.
5. Located stretches go back to documents by class, and words covered by a passage of an earlier owner are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvec.llm.tables import Scratch, arrays, keyed, lists, signed, spread
from quillvec.llm.words import SEGMENT, Words, anchored_runs, grams, merged, overlapping, text_column, text_slices

WINDOW = 13
ANCHOR = 5
#: Classes of one phrase that a task takes; a phrase with more is dealt out.
CLASSES_PER_PART = 2000
#: Passages in one automaton. With at most 21 words each, their words fit the code points of a string.
PASSAGES_PER_AUTOMATON = 40_000
STREAMS_PER_AUTOMATON = 20_000


def removed_passages(docs: DataFrame, window: int = WINDOW, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each document without the words of passages that a document with a smaller ``doc_id`` holds too.

    Returns ``doc_id, text`` and the columns named in ``carry``, with ``n_words``, ``n_removed``, ``removed`` (maximal
    runs of removed words, half-open, by number of the word), ``kept`` (remaining words joined by one space) and
    ``text``, the text without the removed words; a text that loses nothing is unchanged. Judged on the input.

    A NULL text has no words and stays NULL; a NULL ``doc_id`` comes after all others, and such rows count as one
    document. Rows with the same id never remove anything from each other. Texts shorter than a window lose nothing.
    Other columns are left out.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    source = keyed(docs, *carry)
    runs = phrase_runs(source, window)
    # Tables of their own, so that the join of a very frequent phrase or class can be split.
    recurring = scratch.keep(runs.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b")
                             .select("key"), "recurring")
    found = scratch.keep(runs.join(recurring, "key", "left_semi"), "found")
    scratch.drop("recurring")
    classes = scratch.keep(found.groupBy("key", "whole").agg(
        F.min("id").alias("owner"), F.max("id").alias("last"), F.first("n").alias("n")), "classes")
    # Parts into which a phrase is dealt, if it has several classes.
    parts = scratch.keep(classes.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(
        "key", spread(F.col("n"), CLASSES_PER_PART).alias("parts")), "parts")
    several = scratch.keep(classes.join(parts, "key").drop("n"), "several")
    stretches = scratch.keep(_stretches(source, _representatives(found, several), window), "stretches")
    scratch.drop("several")
    located = scratch.keep(_located(stretches, window, scratch), "located")
    scratch.drop("stretches", "windows")
    # The only class of a phrase is a passage as a whole.
    single = classes.join(parts, "key", "left_anti").filter("owner < last").select(
        "key", "whole", F.lit(0).alias("start"), (F.col("n") + (window - 1)).alias("end"), "owner")
    spans = found.select("id", "sub", "lo", "key", "whole").join(located.unionByName(single), ["key", "whole"]) \
        .filter("id > owner").groupBy("id", "sub").agg(F.collect_list(F.struct(
            (F.col("lo") + F.col("start")).alias("lo"), (F.col("lo") + F.col("end")).alias("hi"))).alias("spans"))
    row = source.schema["row"].dataType.simpleString()
    out = source.join(spans, ["id", "sub"], "left").select("row", "text", "spans").mapInArrow(
        _removals, f"row {row}, text string, n_words long, n_removed long, "
                   "removed array<struct<lo:int,hi:int>>, kept string")
    return out.select("row.*", "text", "n_words", "n_removed", "removed", "kept")


def phrase_runs(source: DataFrame, window: int = WINDOW) -> DataFrame:
    """``key`` (hash of an anchor phrase), and the run of ``n`` windows filed under it from word ``lo`` on; ``whole``
    stands for all words of the run."""
    size = min(ANCHOR, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, subs = arrays(batch, "id", "sub")
            for first, _, data, offsets in text_slices(text_column(batch)):
                words = Words(data, offsets)
                ends = np.repeat(words.first[1:], words.counts)
                owner = words.owners()
                gram = grams(words.hashes, size)
                for lo, hi in overlapping(ends, window):
                    part = gram[lo:max(lo, hi - size + 1)]
                    anchor, head, tail = anchored_runs(part, ends[lo:hi] - lo, window, size)
                    raw = words.hashes[lo:hi].tobytes()
                    whole = np.fromiter(map(xxhash.xxh3_64_intdigest, map(raw.__getitem__, map(
                        slice, (8 * head).tolist(), (8 * (tail + window)).tolist()))), np.uint64, len(head))
                    doc = owner[head + lo]
                    yield pa.RecordBatch.from_arrays(
                        [signed(part[anchor]), signed(whole), ids[first + doc], subs[first + doc],
                         (head + lo - words.first[doc]).astype(np.int32), (tail - head + 1).astype(np.int32)],
                        ["key", "whole", "id", "sub", "lo", "n"])

    return source.select("id", "sub", "text").mapInArrow(
        run, "key long, whole long, id long, sub long, lo int, n int")


def _representatives(found: DataFrame, classes: DataFrame) -> DataFrame:
    """One run of each class, in a document with its smallest id."""
    runs = found.join(classes.withColumnRenamed("owner", "id"), ["key", "whole", "id"])
    return runs.groupBy("key", "whole", "id", "last", "parts").agg(*[F.first(c).alias(c) for c in ("sub", "lo", "n")])


def _stretches(source: DataFrame, runs: DataFrame, window: int) -> DataFrame:
    """The words of each run, joined by one space, and the hashes of its windows."""
    by_text = runs.groupBy("id", "sub").agg(F.collect_list(F.struct(
        "key", "whole", "last", "parts", "lo", "n")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, = arrays(batch, "id")
            at, fields = lists(batch.column(batch.schema.get_field_index("runs")))
            for first, after, data, offsets in text_slices(text_column(batch)):
                words = Words(data, offsets)
                gram = grams(words.hashes, window)
                raw = data.tobytes()
                for a, b in _parts(at, first, after):
                    doc = np.searchsorted(at, np.arange(a, b), "right") - 1
                    head, n = words.first[doc - first] + fields["lo"][a:b], fields["n"][a:b]
                    start, end = words.starts[head], words.ends[head + n + window - 2]
                    texts = [b" ".join(raw[s:e].split()) for s, e in zip(start.tolist(), end.tolist(), strict=True)]
                    place = np.r_[0, np.cumsum(n)]
                    hashes = signed(gram[np.arange(place[-1]) + np.repeat(head - place[:-1], n)])
                    yield pa.RecordBatch.from_arrays(
                        [fields["key"][a:b], fields["whole"][a:b], ids[doc], fields["last"][a:b], fields["parts"][a:b],
                         pa.array(texts, pa.binary()).cast(pa.string()),
                         pa.ListArray.from_arrays(place.astype(np.int32), hashes)],
                        ["key", "whole", "owner", "last", "parts", "stretch", "windows"])

    # Equal rows of one document meet its runs more than once, which changes nothing.
    return source.select("id", "sub", "text").join(by_text, ["id", "sub"]).mapInArrow(
        run, "key long, whole long, owner long, last long, parts int, stretch string, windows array<long>")


def _parts(at: np.ndarray, first: int, after: int, size: int = 100_000) -> Iterator[tuple[int, int]]:
    for a in range(int(at[first]), int(at[after]), size):
        yield a, min(a + size, int(at[after]))


def _located(stretches: DataFrame, window: int, scratch: Scratch) -> DataFrame:
    """Where recurring passages lie in each class: ``owner`` is the smallest id that holds those words.

    Windows are counted by hash, and each part of a phrase gets those that recur and that its classes hold; a task finds
    their words there.
    """
    part = F.expr("IF(parts > 1, pmod(whole, parts), 0)").cast("int").alias("part")
    windows = stretches.select("key", part, "owner", "last", F.explode("windows").alias("whole")) \
        .groupBy("key", "whole", "part").agg(F.min("owner").alias("owner"), F.max("last").alias("last"))
    # Most phrases have one part, so this is about as long as the windows of all classes that differ.
    windows = scratch.keep(windows, "windows")
    shared = windows.groupBy("key", "whole").agg(F.min("owner").alias("least"), F.max("last").alias("last")) \
        .filter("least < last").select("key", "whole", "least")
    held = windows.select("key", "whole", "part").join(shared, ["key", "whole"])
    nothing = F.lit(None)
    passages = held.select("key", "part", F.lit(1).alias("kind"), "whole", nothing.cast("string").alias("stretch"),
                           nothing.cast("array<bigint>").alias("windows"), F.col("least").alias("owner"),
                           nothing.cast("bigint").alias("last"))
    streams = stretches.select("key", part, F.lit(0).alias("kind"), "whole", "stretch", "windows", "owner", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _stream(batches, window)

    return streams.unionByName(passages).repartition("key", "part").sortWithinPartitions("key", "part", "kind") \
        .mapInArrow(run, "key long, whole long, start int, end int, owner long")


def _stream(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Takes the classes and then the recurring windows of phrase after phrase, and runs an automaton over a block."""
    streams: list[tuple[int, int, str, int, list[int]]] = []
    passages: dict[str, int] = {}
    hashes: dict[int, int] = {}
    current, mark = None, 0  # the phrase, and its first class among the streams
    for batch in batches:
        columns = (batch.column(batch.schema.get_field_index(c)).to_pylist()
                   for c in ("key", "part", "kind", "whole", "stretch", "windows", "owner", "last"))
        for key, part, kind, whole, stretch, windows, owner, last in zip(*columns, strict=True):
            if (key, part) != current:
                _confirm(streams[mark:], hashes, passages, window)
                if len(passages) >= PASSAGES_PER_AUTOMATON or len(streams) >= STREAMS_PER_AUTOMATON:
                    yield from _locate(streams, passages)
                    streams, passages = [], {}
                current, mark, hashes = (key, part), len(streams), {}
            if kind == 0:
                streams.append((key, whole, stretch, last, windows))
                if owner < last:
                    passages[stretch] = min(owner, passages.get(stretch, owner))
            else:
                hashes[whole] = owner
                if len(hashes) >= PASSAGES_PER_AUTOMATON:
                    _confirm(streams[mark:], hashes, passages, window)
                    yield from _locate(streams, passages)
                    # Classes of this phrase wait for the rest of its passages.
                    streams, passages, mark, hashes = streams[mark:], {}, 0, {}
    _confirm(streams[mark:], hashes, passages, window)
    yield from _locate(streams, passages)


def _confirm(streams: list[tuple[int, int, str, int, list[int]]], hashes: dict[int, int], passages: dict[str, int],
             window: int) -> None:
    """Adds the windows of ``streams`` whose hash recurs to the passages."""
    if not hashes:
        return
    for _, _, stretch, _, windows in streams:
        at = [i for i, h in enumerate(windows) if h in hashes]
        if at:
            words = stretch.split(" ")
            for i in at:
                text, owner = " ".join(words[i:i + window]), hashes[windows[i]]
                passages[text] = min(owner, passages.get(text, owner))


def _locate(streams: list[tuple[int, int, str, int, list[int]]], passages: dict[str, int]) -> Iterator[pa.RecordBatch]:
    if not passages or not streams:
        return
    code: dict[str, str] = {}
    automaton = ahocorasick.Automaton()
    for passage, owner in passages.items():
        words = passage.split(" ")
        for w in words:
            if w not in code:
                point = len(code) + 1
                code[w] = chr(point if point < 0xD800 else point + 0x800)
        automaton.add_word("".join([code[w] for w in words]), (owner, len(words)))
    automaton.make_automaton()
    rows: list[tuple[int, int, int, int, int]] = []
    for key, whole, stretch, last, _ in streams:
        words = stretch.split(" ")
        least = [last] * len(words)  # smallest owner of a passage over each word
        hit = False
        for end, (owner, length) in automaton.iter("".join([code.get(w, "\0") for w in words])):
            if owner < last:
                hit = True
                for i in range(end - length + 1, end + 1):
                    if owner < least[i]:
                        least[i] = owner
        if not hit:
            continue
        start = 0
        for i in range(1, len(words) + 1):
            if i == len(words) or least[i] != least[start]:
                if least[start] < last:
                    rows.append((key, whole, start, i, least[start]))
                start = i
    if rows:
        kinds = (np.int64, np.int64, np.int32, np.int32, np.int64)
        yield pa.RecordBatch.from_arrays(
            [np.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            ["key", "whole", "start", "end", "owner"])


def _removals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_column(batch)
        null = texts.is_null().to_numpy(zero_copy_only=False)
        at, fields = lists(batch.column(batch.schema.get_field_index("spans")))
        for first, after, data, offsets in text_slices(texts):
            words = Words(data, offsets)
            raw = data.tobytes()
            out, kept, removed, n_removed = [], [], [], []
            for i in range(after - first):
                whole = raw[offsets[i]:offsets[i + 1]]
                spans = slice(at[first + i], at[first + i + 1])
                if spans.start == spans.stop:
                    out.append(None if null[first + i] else whole)
                    kept.append(b" ".join(whole.split()))
                    removed.append([])
                    n_removed.append(0)
                    continue
                lo, hi = merged(fields["lo"][spans], fields["hi"][spans])
                # The text goes from the first removed word up to the next one that stays.
                head = words.first[i]
                marks = np.append(words.starts[head:words.first[i + 1]], offsets[i + 1])
                cut_from, cut_to = marks[lo].tolist(), marks[hi].tolist()
                rest = b"".join(raw[a:b] for a, b in zip([int(offsets[i]), *cut_to], [*cut_from, int(offsets[i + 1])],
                                                        strict=True))
                out.append(rest)
                kept.append(b" ".join(rest.split()))
                removed.append([{"lo": int(a), "hi": int(b)} for a, b in zip(lo, hi, strict=True)])
                n_removed.append(int((hi - lo).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("row")).slice(first, after - first),
                 pa.array(out, pa.binary()).cast(pa.string()), words.counts.astype(np.int64),
                 np.array(n_removed, np.int64),
                 pa.array(removed, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                ["row", "text", "n_words", "n_removed", "removed", "kept"])

