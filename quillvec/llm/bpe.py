"""Byte-level BPE from a file of ranks, by the ``tokenizers`` library over Arrow batches.

The library merges the pair with the best place in a list of pairs, while ranks belong to what a pair gives. So every
way to split a token into two others is listed, tokens in the order of their ranks: whichever pair comes up, it merges
when its result is due. Of two splits of one token the one with the longer left part comes first, which is the left
one where they overlap. A piece found as a whole among the tokens is taken as it is.

Bytes are written as printable characters, one for one, as byte-level BPE does: printable Latin-1 stands for itself,
other bytes move beyond 255. Decoding looks up the bytes of each token and lays them end to end, so a character
that is split between tokens comes out whole.

The pattern's classes of letters, numbers and white space are spelled out once, which lets Python's own expressions
split a text; pieces seen before are not encoded again.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from quillvec.llm.words import text_column

#: White space of the pattern, whatever a library thinks of control characters.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Pieces whose ids a worker remembers; beyond, it starts anew.
REMEMBERED = 600_000
#: Bytes of text encoded at a time.
CHUNK = 1 << 20


#: The usual pattern, with names for its classes.
SHAPE = r"'s|'t|'re|'ve|'m|'ll|'d| ?LETTER+| ?NUMBER+| ?OTHER+|\s+(?!\S)|\s+"


def byte_characters() -> list[str]:
    """The character that stands for each byte."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


def spelled_out(pattern: str) -> str:
    """The pattern with ``\\s``, ``\\S`` and ``\\p{..}`` as plain ranges of characters, for the ``re`` module."""
    ranges: dict[str, str] = {r"\s": WHITE}
    everything = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))

    def members(name: str) -> str:
        if name not in ranges:
            found = regex.finditer(f"{name}+", everything)
            ranges[name] = "".join(f"{re.escape(x)}-{re.escape(y)}" if x != y else re.escape(x)
                                   for m in found for x, y in _stretches(m[0]))
        return ranges[name]

    out, inside, at = [], False, 0
    for m in regex.finditer(r"\\p\{\w+\}|\\.|\[|\]", pattern):
        out.append(pattern[at:m.start()])
        at, token = m.end(), m[0]
        if token in "[]":
            inside = token == "["
            out.append(token)
        elif token.startswith(r"\p") or token == r"\s":
            out.append(members(token) if inside else f"[{members(token)}]")
        elif token == r"\S" and not inside:
            out.append(f"[^{members(chr(92) + 's')}]")
        elif token == r"\S":
            raise ValueError("a class that holds \\S can't be spelled out")
        else:
            out.append(token)
    return "".join(out) + pattern[at:]


def _stretches(text: str) -> Iterator[tuple[str, str]]:
    """First and last of each run of neighbouring code points."""
    points = np.array([ord(c) for c in text])
    cut = np.flatnonzero(np.diff(points) != 1) + 1
    for part in np.split(points, cut):
        yield chr(part[0]), chr(part[-1])


class Codec:
    """Encoder and decoder for one file of ranks and one pattern."""

    def __init__(self, data: bytes, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        ranks = parse_ranks(data)
        chars = byte_characters()
        names = {t: "".join([chars[b] for b in t]) for t in ranks}
        merges = [(names[t[:i]], names[t[i:]]) for t in sorted(ranks, key=ranks.__getitem__)
                  for i in range(len(t) - 1, 0, -1) if t[:i] in ranks and t[i:] in ranks]
        self.model = models.BPE(vocab={names[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
        self.tokenizer = Tokenizer(self.model)
        self.odd_pieces = re.compile(spelled_out(pattern)).findall
        self.plain_pieces, self.odd = self.odd_pieces, frozenset()
        if pattern == SHAPE.replace("LETTER", r"\p{L}").replace("NUMBER", r"\p{N}").replace("OTHER", r"[^\s\p{L}\p{N}]"):
            # Python's word characters are letters, numbers and the underscore; with the numbers that are no
            # digits set aside, its own classes say the same and are much faster.
            plain = SHAPE.replace("LETTER", r"[^\W\d_]").replace("NUMBER", r"\d").replace("OTHER", r"(?:[^\s\w]|_)")
            self.plain_pieces = re.compile(plain.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]")
                                           .replace(r"\S", f"[^{WHITE}]")).findall
            everything = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
            letters, numbers = (set(regex.findall(x, everything)) for x in (r"\p{L}", r"\p{N}"))
            differ = [c for c in everything
                      if (0 if c in letters else 1 if c in numbers else -1)
                      != (1 if c.isdecimal() else 0 if c.isalnum() else -1)]
            self.odd = frozenset(differ)
        self.chars = dict(enumerate(chars))
        self.known: dict[str, bytes] = {}
        size = max(ranks.values()) + 1
        ordered = [b""] * size
        for token, rank in ranks.items():
            ordered[rank] = token
        self.lengths = np.array([len(t) for t in ordered], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)

    def _learn(self, pieces: list[str]) -> None:
        """Ids of new pieces, as the bytes of their numbers."""
        written = [p.encode().decode("latin-1").translate(self.chars) for p in pieces]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(written, add_special_tokens=False)]
        ends = (4 * np.cumsum([len(f) for f in found])).tolist()
        data = np.fromiter(chain.from_iterable(found), np.int32).tobytes()
        self.known.update(zip(pieces, map(data.__getitem__, map(slice, [0, *ends], ends)), strict=True))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts end to end, and where each starts."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        pieces = [(self.plain_pieces if self.odd.isdisjoint(t) else self.odd_pieces)(t) if t else [] for t in texts]
        self._learn(list(set(chain.from_iterable(pieces)).difference(self.known)))
        data = [b"".join(map(self.known.__getitem__, p)) for p in pieces]
        return np.frombuffer(b"".join(data), np.int32), np.r_[0, np.cumsum([len(d) // 4 for d in data])]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of many sequences of ids laid end to end, and where each starts."""
        lengths = self.lengths[ids]
        ends = np.r_[0, np.cumsum(lengths)]
        place = np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends[:-1], lengths)
        return self.bytes[place], ends[offsets]

    def character_ends(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Characters of its text that begin before the end of each token."""
        data, _ = self.decode(ids, offsets)
        begun = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        ends = begun[np.cumsum(self.lengths[ids])]
        before = np.r_[0, ends][offsets[:-1]]
        return (ends - np.repeat(before, np.diff(offsets))).astype(np.int32)


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(data: bytes, pattern: str) -> Codec:
    """One codec per worker for each file and pattern."""
    key = (hashlib.sha256(data).hexdigest(), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(data, pattern)
    return _CODECS[key]


def _rank_file(df: DataFrame, path: str):
    """The file of ranks, read here and sent to the workers; a vocabulary has a fixed size."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _ranges(lengths: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Rows that together have about ``size``, or one larger row alone."""
    ends, first = np.cumsum(lengths), 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        after = max(first + 1, int(np.searchsorted(ends, before + size, "right")))
        yield first, after
        first = after


def encode(docs: DataFrame, path: str, pattern: str, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns named in ``carry``, and for each whole text ``ids`` and ``ends``: for each token, how many
    characters of the text begin before its end.

    No special tokens: their names in a text are ordinary text. A NULL or empty text has no ids. Every row gives a
    row, repeated ones too; columns not in ``carry`` are left out, so their names don't matter.
    """
    ranks = _rank_file(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(ranks.value, pattern)
        for batch in batches:
            texts = text_column(batch)
            sizes = texts.fill_null("").cast(pa.large_string())
            sizes = np.diff(np.frombuffer(sizes.buffers()[1], np.int64, len(sizes) + 1, sizes.offset * 8)) \
                if len(sizes) else np.zeros(0, np.int64)
            for first, after in _ranges(sizes, CHUNK):
                ids, offsets = tool.encode(texts.slice(first, after - first).to_pylist())
                offsets = offsets.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index("row")).slice(first, after - first),
                     pa.ListArray.from_arrays(offsets, ids),
                     pa.ListArray.from_arrays(offsets, tool.character_ends(ids, offsets))], ["row", "ids", "ends"])

    source = _with_row(docs, carry, "text")
    row = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {row}, ids array<int>, ends array<int>").select("row.*", "ids", "ends")


def decode(encoded: DataFrame, path: str, pattern: str, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns named in ``carry``, and ``decoded``: the bytes that ``ids`` stand for.

    They are UTF-8 if the ids are those of a whole text. NULL ids give no bytes. Ids must be those of the file.
    """
    ranks = _rank_file(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(ranks.value, pattern)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            sizes = np.zeros(len(column), np.int64)
            if len(column):
                sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, after in _ranges(sizes, CHUNK):
                part = column.slice(first, after - first)
                data, at = tool.decode(part.flatten().to_numpy(), np.r_[0, np.cumsum(sizes[first:after])])
                decoded = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), after - first, [None, pa.py_buffer(at.astype(np.int64).tobytes()),
                                                       pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index("row")).slice(first, after - first),
                     decoded.cast(pa.binary())], ["row", "decoded"])

    source = _with_row(encoded, carry, "ids")
    row = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {row}, decoded binary").select("row.*", "decoded")


def _with_row(df: DataFrame, carry: tuple[str, ...], column: str) -> DataFrame:
    return df.select(F.struct(*carry).alias("row"), column)
