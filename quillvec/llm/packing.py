"""Packing of documents into sequences of one length, shortest pack first over the histogram of lengths.

1. Each text is encoded once, and its ids are written with the document's place: which task wrote it, and how many
   documents of the same remaining length that task wrote before.
2. A document fills whole sequences; what remains is shorter than one. Only counts of remaining lengths, one number
   for each length, reach the driver.
3. Lengths are placed longest first, all documents of a length at once: into the packs with most room, as long as they
   have enough, else into new packs. What is kept are patterns of pieces, each with the number of packs that look so.
4. Closing: the least filled packs are taken apart and cut to fill the gaps of the others. A pack of a power of two
   needs no padding and stays; of the last pack, each power of two becomes a sequence.
5. A pattern names its pieces by remaining length and ranks. A document's rank is its place in its task after those of
   earlier tasks, so documents find their pieces without being sorted or gathered.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillvec.llm.byte_ids import byte_ids
from quillvec.llm.tables import Scratch
from quillvec.llm.words import text_column, text_slices
from quillvec.storage import sized

LENGTH = 1024
#: Bytes of text encoded at a time; the more, the fewer different pieces there are to each byte.
SLICE = 1 << 23
#: The id behind each document.
END = 0
#: Parts (tasks that wrote ids) whose places are sent to all; each has at most LENGTH numbers.
PARTS_SENT = 1000


@dataclass(frozen=True)
class Piece:
    """``length`` ids from ``start`` on, of what remains of a document with ``rest`` ids; ``rank`` in the first pack."""
    rest: int
    rank: int
    start: int
    length: int


@dataclass
class Pattern:
    """``count`` packs that look alike; in each following pack, pieces belong to documents of the next rank."""
    count: int
    pieces: list[Piece]

    @property
    def filled(self) -> int:
        return sum(p.length for p in self.pieces)

    def split(self, first: int) -> tuple[Pattern, Pattern]:
        rest = [replace(p, rank=p.rank + first) for p in self.pieces]
        return Pattern(first, self.pieces), Pattern(self.count - first, rest)


def packed(histogram: dict[int, int], length: int = LENGTH) -> list[Pattern]:
    """Packs of at most ``length`` for so many documents of each remaining length below it.

    The result's size follows the number of lengths, not of documents.
    """
    return _closed(_placed(histogram, length), length)


def _placed(histogram: dict[int, int], length: int) -> list[Pattern]:
    """Shortest pack first, longest length first."""
    by_room: dict[int, list[Pattern]] = defaultdict(list)
    rooms: list[int] = []  # a heap of -room

    def add(pattern: Pattern) -> None:
        room = length - pattern.filled
        if not by_room[room]:
            heappush(rooms, -room)
        by_room[room].append(pattern)

    for size in sorted(histogram, reverse=True):
        left, rank = histogram[size], 0
        while left:
            if rooms and -rooms[0] >= size:
                room = -rooms[0]
                pattern = by_room[room].pop()
                if not by_room[room]:
                    heappop(rooms)
                if pattern.count > left:
                    pattern, other = pattern.split(left)
                    add(other)
                add(Pattern(pattern.count, [*pattern.pieces, Piece(size, rank, 0, size)]))
                rank, left = rank + pattern.count, left - pattern.count
            else:
                # New packs take as many of this length as fit.
                each = min(left, length // size)
                count = left // each
                add(Pattern(count, [Piece(size, rank + k * count, 0, size) for k in range(each)]))
                rank, left = rank + each * count, left - each * count
    return [p for patterns in by_room.values() for p in patterns]


def _closed(patterns: list[Pattern], length: int) -> list[Pattern]:
    """Patterns without padding: the least filled packs are taken apart, and their pieces fill the gaps of the others.

    As many packs are taken apart as the gaps of the rest need, so less than a pack is left over. A step uses up the
    packs of one pattern or the pieces of one kind, so there are never more of both than in the beginning.
    """
    done = [p for p in patterns if _unpadded(p.filled, length)]
    opened = sorted((p for p in patterns if not _unpadded(p.filled, length)), key=lambda p: p.filled)
    gaps = sum(p.count * (length - p.filled) for p in opened)
    loose: dict[int, list[Pattern]] = defaultdict(list)  # pieces by length, each as a pattern of its own
    rooms: dict[int, list[Pattern]] = defaultdict(list)
    for p in opened:
        # A pack taken apart gives its pieces, and its own gap goes.
        apart = min(p.count, -(-gaps // length)) if gaps > 0 else 0
        gaps -= apart * length
        taken, left = p.split(apart)
        if apart:
            for piece in taken.pieces:
                loose[piece.length].append(Pattern(apart, [piece]))
        if left.count:
            rooms[length - p.filled].append(left)
    sizes, spaces = [-x for x in loose], [-x for x in rooms]
    heapify(sizes)
    heapify(spaces)

    def put(table: dict[int, list[Pattern]], heap: list[int], size: int, pattern: Pattern) -> None:
        if not table[size]:
            heappush(heap, -size)
        table[size].append(pattern)

    def take(table: dict[int, list[Pattern]], heap: list[int]) -> tuple[int, Pattern]:
        size = -heap[0]
        pattern = table[size].pop()
        if not table[size]:
            heappop(heap)
        return size, pattern

    while spaces:
        room, pack = take(rooms, spaces)
        size, piece = take(loose, sizes)
        count = min(pack.count, piece.count)
        pack, spare = pack.split(count)
        if spare.count:
            put(rooms, spaces, room, spare)
        piece, spare = piece.split(count)
        if spare.count:
            put(loose, sizes, size, spare)
        first, = piece.pieces
        if size > room:
            put(loose, sizes, size - room, Pattern(count, [replace(
                first, start=first.start + room, length=size - room)]))
            first = replace(first, length=room)
        pack = Pattern(count, [*pack.pieces, first])
        if size < room:
            put(rooms, spaces, room - size, pack)
        else:
            done.append(pack)
    rest = [p.split(k)[1].pieces[0] for group in loose.values() for p in group for k in range(p.count)]
    return done + (_powers_of_two(Pattern(1, rest)) if rest else [])


def _unpadded(filled: int, length: int) -> bool:
    return filled == length or filled & (filled - 1) == 0


def _powers_of_two(pattern: Pattern) -> list[Pattern]:
    """The pieces of one pack, dealt out to sequences of the powers of two that its length is made of."""
    filled, out, pieces = pattern.filled, [], list(pattern.pieces)
    for bit in range(filled.bit_length() - 1, -1, -1):
        room = filled & (1 << bit)
        mine: list[Piece] = []
        while room:
            first = pieces.pop(0)
            if first.length > room:
                pieces.insert(0, replace(first, start=first.start + room, length=first.length - room))
                first = replace(first, length=room)
            mine.append(first)
            room -= first.length
        if mine:
            out.append(Pattern(1, mine))
    return out


class Directions:
    """For each remaining length, ranges of ranks and the pieces that their documents are cut into."""

    def __init__(self, patterns: list[Pattern]):
        found: dict[int, list[tuple[int, int, int, int, int, int]]] = defaultdict(list)
        base = 0
        for p in patterns:
            at = 0
            for piece in p.pieces:
                found[piece.rest].append((piece.rank, piece.rank + p.count, piece.start, piece.length,
                                          base - piece.rank, at))
                at += piece.length
            base += p.count
        self.sequences = base
        self.borders: dict[int, list[int]] = {}
        self.pieces: dict[int, list[list[tuple[int, int, int, int]]]] = {}
        for rest, rows in found.items():
            borders = sorted({x for r in rows for x in r[:2]})
            index = {b: k for k, b in enumerate(borders)}
            pieces: list[list[tuple[int, int, int, int]]] = [[] for _ in borders]
            for lo, hi, *piece in rows:
                for k in range(index[lo], index[hi]):
                    pieces[k].append(tuple(piece))
            self.borders[rest], self.pieces[rest] = borders, [sorted(x) for x in pieces]

    def of(self, rest: int, rank: int) -> list[tuple[int, int, int, int]]:
        """``(start, length, sequence, offset)`` of each piece of the document."""
        found = self.pieces[rest][bisect_right(self.borders[rest], rank) - 1]
        return [(start, length, shift + rank, at) for start, length, shift, at in found]


def pack(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, carry: tuple[str, ...] = ("doc_id",),
         ids: bool = True) -> DataFrame:
    """Pieces of all documents, laid into sequences of at most ``length`` ids.

    ``path`` is a tokenizer file; a document is the ids of its text without added special tokens, and ``end``. Returns
    the columns in ``carry``, with ``start``, ``length``, ``ids`` (unless left out), ``ids_crc32`` of little-endian 32-bit
    ids, ``doc_tokens``, ``sequence_id`` (dense from 0) and ``offset``. No sequence is padded: each has ``length`` ids or,
    once in all, a power of two.

    A NULL or empty text is one id, ``end``. Every row is a document of its own, also when rows repeat or ids are NULL.
    Long texts are cut like others. Columns not in ``carry`` are left out, so their names don't matter. No documents
    give no pieces.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    encoded = scratch.keep(_encoded(docs, path, length, end, carry), "ids")
    # One number for each task and remaining length; ``length`` itself stands for whole sequences.
    counts = scratch.keep(encoded.select("part", F.stack(
        F.lit(2), (F.col("n") % length).cast("int"), F.lit(1).cast("long"), F.lit(length),
        F.floor(F.col("n") / length)).alias("rest", "n")).filter("rest > 0 AND n > 0")
        .groupBy("part", "rest").agg(F.sum("n").alias("n")), "counts")
    totals = {r.rest: r.n for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}  # at most ``length`` rows
    wholes = totals.pop(length, 0)
    directions = spark.sparkContext.broadcast(Directions(packed(totals, length)))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("rest").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    places = scratch.keep(counts.select("part", "rest", before.alias("first")).groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("rest", "first"))).alias("first")), "places")
    row = encoded.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = directions.value
        for batch in batches:
            column = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
            n = column["n"].to_numpy()
            if not len(n):
                continue
            ends, raw = np.cumsum(n), b"".join(column["ids"].to_pylist())
            flat = np.frombuffer(raw, f"<u{len(raw) // ends[-1]}").astype("<u4")
            out: list[tuple[int, int, int, int, int]] = []
            for i, (size, place, sequence) in enumerate(zip(
                    n.tolist(), column["place"].to_pylist(), column["sequence"].to_pylist(), strict=True)):
                whole, rest = divmod(size, length)
                out += [(i, k * length, length, sequence + k, 0) for k in range(whole)]
                if rest:
                    out += [(i, whole * length + start, part, wholes + to, at)
                            for start, part, to, at in found.of(rest, place)]
            doc, start, size, sequence, offset = (np.array(x) for x in zip(*out, strict=True))
            lo = (ends - n)[doc] + start
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(lo.tolist(), (lo + size).tolist(), strict=True)]
            columns = [column["row"].take(pa.array(doc)), start, size, np.array(crc, np.int64), n[doc], sequence, offset]
            names = ["row", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if ids:
                # Pieces of a document needn't come in order of their ids.
                place = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
                columns.append(pa.ListArray.from_arrays(np.r_[0, np.cumsum(size)].astype(np.int32), flat[place].view(np.int32)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names)

    placed = encoded.join(sized(places, PARTS_SENT), "part").select(
        "row", "ids", "n", (F.col("place") + F.element_at("first", (F.col("n") % length).cast("int"))).alias("place"),
        (F.col("sequence") + F.element_at("first", F.lit(length))).alias("sequence"))
    schema = (f"row {row}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + (", ids array<int>" if ids else ""))
    return placed.mapInArrow(run, schema).select("row.*", *[c.split()[0] for c in schema.split(", ")[-6 - ids:]])


def _encoded(docs: DataFrame, path: str, length: int, end: int, carry: tuple[str, ...]) -> DataFrame:
    """``row, ids, n``, and where it lies: the ``part`` that wrote it, ``place`` among documents of the same remaining
    length there, and the number of whole sequences there before it.

    ``ids`` are bytes, equally many for each id, since the JVM takes an array apart number by number."""
    with open(path, "rb") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary has a fixed size
    source = docs.select(F.struct(*carry).alias("row"), "text")
    row = source.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = byte_ids(file.value, True)
        part, places, sequence = TaskContext.get().partitionId(), [0] * length, 0
        filler = end % 2**32
        width = np.min_scalar_type(max(len(tool.spaced) - 1, filler)).itemsize
        for batch in batches:
            texts = text_column(batch)
            for first, after, *_ in text_slices(texts, SLICE):
                ids, at = tool.encode([t or "" for t in texts.slice(first, after - first).to_pylist()])
                n = np.diff(at) + 1
                where, before = [], []
                for size in n.tolist():
                    whole, rest = divmod(size, length)
                    where.append(places[rest])
                    before.append(sequence)
                    places[rest] += 1
                    sequence += whole
                ends = np.cumsum(n)
                laid, text = np.full(ends[-1], filler, f"<u{width}"), np.ones(ends[-1], bool)
                text[ends - 1] = False
                laid[text] = ids
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index("row")).slice(first, after - first),
                     pa.Array.from_buffers(pa.binary(), len(n), [
                         None, pa.py_buffer((width * np.r_[0, ends]).astype(np.int32)), pa.py_buffer(laid)]), pa.array(n),
                     pa.array(np.full(len(n), part, np.int32)), pa.array(where, pa.int64()), pa.array(before, pa.int64())],
                    ["row", "ids", "n", "part", "place", "sequence"])

    return source.mapInArrow(run, f"row {row}, ids binary, n long, part int, place long, sequence long")
