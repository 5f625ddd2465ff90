"""Ids of a byte-level BPE tokenizer file by the ``tokenizers`` library, with pieces remembered.

The library cuts a text into pieces before it merges, so equal pieces have equal ids. Texts of letters and marks whose
classes are beyond doubt are cut here, and only pieces not seen before go to the library; other texts go there whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from quillvec.llm.bpe import byte_characters

#: Pieces whose ids a worker remembers; beyond, it starts anew.
REMEMBERED = 800_000
LETTER, NUMBER, OTHER, WHITE, END, ODD = range(6)
#: Kinds of Latin letters and usual punctuation, as far as the pattern's classes and Python's agree on them.
_KINDS = np.full(0x20AE, ODD, np.uint8)
for _c in map(chr, chain(range(0x20, 0x7F), range(0xA1, 0x180), range(0x2010, 0x2028), (0x20AC,))):
    if bool(regex.match(r"\p{L}", _c)) == _c.isalpha() and bool(regex.match(r"\p{N}", _c)) == _c.isdecimal() \
            and _c.isalnum() == (_c.isalpha() or _c.isdecimal()):
        _KINDS[ord(_c)] = LETTER if _c.isalpha() else NUMBER if _c.isdecimal() else OTHER
_KINDS[[ord(_c) for _c in "\t\n\x0b\x0c\r "]] = WHITE
#: The piece at the end of a text, which has no ids.
_NOTHING = bytes(2)


def _kinds(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of texts end to end, with one more behind each; their kinds; and where the ends are."""
    codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) - 1
    kind = _KINDS[np.minimum(codes, len(_KINDS) - 1)]
    kind[ends] = END
    return codes, kind, ends


def _starts(codes: np.ndarray, kind: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where ``bpe.SHAPE`` begins a piece, in texts without odd characters; each end is a piece too."""
    dark = kind < WHITE
    start = np.ones(len(kind), bool)
    start[1:] = kind[1:] != kind[:-1]
    start[ends] = True
    start[1:] &= ~(dark[1:] & (codes[:-1] == ord(" ")))  # a space goes with what follows
    start[:-1] |= (kind[:-1] == WHITE) & dark[1:]  # the last of several blanks is left to it
    at = np.flatnonzero(start & (codes == ord("'")))
    first, second = codes[at + 1], codes[np.minimum(at + 2, len(codes) - 1)]
    short = np.isin(first, [ord(c) for c in "stmd"])
    long = np.isin(first, [ord("r"), ord("v")]) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
    start[at[short | long] + 1] = False
    start[np.r_[at[short] + 2, at[long] + 3]] = True
    return np.flatnonzero(start)


class Numbers:
    """Numbers of pieces, in the order in which they were first seen. Pieces have two bytes for each character."""

    def __init__(self):
        self.pieces = pa.array([_NOTHING], pa.large_binary())

    def __len__(self) -> int:
        return len(self.pieces)

    def of(self, pieces: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """The number of each piece, and those pieces that had none before."""
        before = len(self)
        if not len(pieces):
            return np.zeros(0, np.int32), pieces
        # With those already numbered in front, Arrow's dictionary goes on where it ended.
        found = pa.chunked_array([self.pieces, pieces]).dictionary_encode().chunk(1)
        self.pieces = found.dictionary
        return found.indices.to_numpy(), self.pieces[before:]


class ByteIds:
    """``special`` tells whether the names of special tokens in a text stand for those tokens."""

    def __init__(self, file: bytes, special: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_str(file.decode())
        self.tokenizer.encode_special_tokens = not special
        names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, names))) if names else None
        self.special = self.added if special else None
        self._forget()
        vocabulary, space = self.tokenizer.get_vocab(), byte_characters()[ord(" ")]
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.spaced[[i for name, i in vocabulary.items() if name[:1] == space]] = True

    def _forget(self) -> None:
        self.known = Numbers()
        #: Ids of all pieces end to end; where those of each number start, and how many there are.
        self.ids, self.starts, self.sizes = np.empty(0, np.int32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids end to end, and how many each text has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.int32), np.array([len(f) for f in found], np.int64)

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of a space and something else. Laid end to end the library cuts them as they are, and only the first
        token of each starts with a space, so that one call for all tells them apart."""
        line = "".join(pieces)
        if not pieces or (self.added and self.added.search(line)):
            return self._whole(pieces)
        ids = np.array(self.tokenizer.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.int32)
        starts = np.flatnonzero(self.spaced[ids])
        if len(starts) != len(pieces) or starts[:1].any():
            return self._whole(pieces)
        return ids, np.diff(starts, append=len(ids))

    def _learn(self, pieces: pa.Array) -> None:
        """Ids of pieces that just got their numbers."""
        at = np.frombuffer(pieces.buffers()[1], np.int64, len(pieces) + 1, 8 * pieces.offset) // 2
        codes = np.frombuffer(pieces.buffers()[2], np.uint16)[at[0]:at[-1]]
        at, line = at - at[0], codes.tobytes().decode("utf-16-le")
        new = [line[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        joined = (codes[at[:-1]] == ord(" ")) & (_KINDS[codes[at[1:] - 1]] != WHITE)
        sizes = np.empty(len(new), np.int64)
        (ids, sizes[joined]), (others, sizes[~joined]) = (
            self._pieces(list(compress(new, joined))), self._whole(list(compress(new, ~joined))))
        order = np.r_[np.flatnonzero(joined), np.flatnonzero(~joined)]
        starts = np.empty(len(new), np.int64)
        starts[order] = len(self.ids) + np.cumsum(sizes[order]) - sizes[order]
        self.ids = np.concatenate([self.ids, ids, others])
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])

    def _numbers(self, codes: np.ndarray, kind: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all pieces, those of ends among them, and how many each text has."""
        at = _starts(codes, kind, ends)
        codes = codes.astype(np.uint16)  # characters beyond are odd
        number, new = self.known.of(pa.Array.from_buffers(pa.large_binary(), len(at), [
            None, pa.py_buffer(2 * np.r_[at, len(codes)].astype(np.int64)), pa.py_buffer(codes)]))
        if len(new):
            self._learn(new)
        return number, np.diff(np.flatnonzero(kind[at] == END), prepend=-1)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts end to end, and where each starts."""
        if len(self.known) > REMEMBERED:
            self._forget()
        codes, kind, ends = _kinds(texts)
        odd = np.array([bool(self.special and self.special.search(t)) for t in texts], bool)
        odd[np.searchsorted(ends, np.flatnonzero(kind == ODD))] = True
        if odd.any():
            codes, kind, ends = _kinds(list(compress(texts, ~odd)))
        counts = np.ones(len(texts), np.int64)
        plain, counts[~odd] = self._numbers(codes, kind, ends)
        number, whole = np.empty(counts.sum(), np.int64), np.repeat(odd, counts)
        number[~whole] = plain
        ids, starts, sizes = self.ids, self.starts, self.sizes
        if odd.any():
            # Numbers for this call only.
            number[whole] = len(sizes) + np.arange(np.count_nonzero(odd))
            more, n = self._whole(list(compress(texts, odd)))
            starts = np.concatenate([starts, len(ids) + np.cumsum(n) - n])
            ids, sizes = np.concatenate([ids, more]), np.concatenate([sizes, n])
        n = sizes[number]
        ends = np.r_[0, np.cumsum(n)]
        place = np.arange(ends[-1])
        place += np.repeat(starts[number] - ends[:-1], n)
        return ids[place], ends[np.r_[0, np.cumsum(counts)]]

    def token_bytes(self) -> list[bytes]:
        """The bytes that each id stands for."""
        byte = {c: b for b, c in enumerate(byte_characters())}
        out = [b""] * self.tokenizer.get_vocab_size()
        for name, i in self.tokenizer.get_vocab().items():
            out[i] = bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode()
        return out


_ENCODERS: dict[tuple[str, bool], ByteIds] = {}


def byte_ids(file: bytes, special: bool) -> ByteIds:
    """One encoder per worker for each file and way to read special tokens."""
    key = (hashlib.sha256(file).hexdigest(), special)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ByteIds(file, special)
    return _ENCODERS[key]
