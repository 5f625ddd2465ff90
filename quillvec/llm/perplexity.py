"""Quality rules with a language model: word rules, then perplexity bands for each language.

Each value of ``lang`` has two interpolated modified Kneser-Ney models, counted over all texts. The long one, of five
bytes, grows with the corpus and knows words and what follows them. A sequence counts once for each text that
holds it, and those that a single text holds are left out of it, as they say nothing about the language and would make each
odd text explain itself. The short one, of three bytes, cannot learn odd texts by heart, so it tells them apart better.

Models are built and kept in shards by the two bytes before the last one: all that a place in a text can ask for, down
to pairs of bytes, lies in one shard. A shard is sorted keys with their probabilities, looked up by binary search. Shards
go to the tasks, ``MODEL_BYTES`` of them at a time; if there are more, the texts are read again for the next.

Probabilities are whole numbers of 2**-20 bits, so sums don't depend on how shards, texts and batches are dealt.

The bands of a language and model come from the texts that pass the word rules: the median of their bits per byte, and the
median distance from it. A text is rejected below or above a number of such distances, by either model.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvec.llm.tables import Scratch
from quillvec.llm.words import SEGMENT, Words, grams, mix, text_column, text_slices

MIN_WORDS = 50
#: Percent of the words that may lie in repeated three-word windows.
REPEAT_PERCENT = 50
#: Median distances from the median at which the bands end.
BELOW, ABOVE, LONG_ABOVE = 8.0, 6.0, 10.0
#: Bits per byte a distance counts as at least.
LEAST_SPREAD = 0.01
#: Bits above the average of its language from which a text is read piece by piece, and bytes of a piece.
STRAY, PIECE = 0.05, 64
#: Shards that a task holds at a time, and sequences of a shard.
MODEL_BYTES, SHARD_KEYS = 256 << 20, 1 << 20
#: Texts that must hold a sequence of five bytes.
LEAST_TEXTS = 2
#: Bytes of the longest sequence, and parts of a bit that probabilities are counted in.
ORDER, SCALE = 5, 1 << 20
MASKS = {k: np.uint64((1 << 8 * k) - 1) for k in range(1, ORDER + 1)}
BYTE, END = np.uint64(8), np.uint64(2**64 - 1)
#: Sequences that a task gathers before it gives them out.
GATHERED = 4 << 20
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


def quality_rules(docs: DataFrame, below: float = BELOW, above: float = ABOVE, long_above: float = LONG_ABOVE,
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """Every row with its word counts, ``base_failed``, ``bits`` and ``long_bits`` (per byte), ``perplexity`` and
    ``kept``.

    A text fails the word rules with fewer than 50 words or with more than half of them in three-word windows that
    occur twice. It is kept if it passes them and its bits lie within the bands of its language, ``low`` to ``high`` by the short
    model and ``long_low`` to ``long_high`` by the long one. Without a model, as for a language with one text, a byte
    has eight bits; passages that another language explains better count by that.

    A NULL text has no words, so it fails; its perplexity is NULL, as is that of an empty one. A NULL ``lang`` is a
    language of its own. Repeated rows count, and come back, each time. Columns besides ``doc_id`` and ``lang`` are left out
    unless named in ``carry``; ``text`` may be named.
    """
    scratch = Scratch(docs.sparkSession, "rules")
    source = docs.select(F.struct("doc_id", *[c for c in carry if c not in ("doc_id", "text")]).alias("row"),
                         F.coalesce("lang", F.lit("")).alias("language"), "text")
    models = scratch.keep(language_models(source, scratch), "models")
    scored = _scored(source, models, "text" in carry, scratch)
    scores = scratch.keep(scored.drop("text") if "text" in carry else scored, "scores")
    bands = scratch.keep(_bands(scores, below, above, long_above), "bands")
    out = (scored if "text" in carry else scores).join(bands, "language", "left")
    inside = F.col("bits").between(F.col("low"), F.col("high")) \
        & F.col("long_bits").between(F.col("long_low"), F.col("long_high"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return out.select("row.*", *(["text"] if "text" in carry else []), "n_words", "word_chars", "n_symbols",
                      "n_dup_lines", "n_repeat_words", "base_failed", "bits", "long_bits",
                      F.pow(F.lit(2.0), "bits").alias("perplexity"), "low", "high", "long_low", "long_high", kept.alias("kept"))


def _bands(scores: DataFrame, below: float, above: float, long_above: float) -> DataFrame:
    """``language, low, high, long_low, long_high``."""
    short = _band(scores, "bits", below, above, "low", "high")
    return short.join(_band(scores, "long_bits", below, long_above, "long_low", "long_high"), "language")


def _band(scores: DataFrame, name: str, below: float, above: float, low: str, high: str) -> DataFrame:
    """Texts are counted by their bits in thousandths first, so that a frequent language is a few thousand rows from
    there on."""
    counted = scores.filter(f"NOT base_failed AND {name} IS NOT NULL") \
        .groupBy("language", F.round(name, 3).alias("bits")).agg(F.count("*").alias("n"))
    middle = counted.groupBy("language").agg(F.expr("percentile(bits, 0.5D, n)").alias("middle"))
    away = counted.join(middle, "language").groupBy("language", "middle").agg(
        F.expr("percentile(abs(bits - middle), 0.5D, n)").alias("away"))
    spread = F.greatest("away", F.lit(LEAST_SPREAD))
    return away.select("language", (F.col("middle") - below * spread).alias(low),
                       (F.col("middle") + above * spread).alias(high))


def _rolled(padded: np.ndarray) -> np.ndarray:
    """One number for each byte from the fifth on and the four before it."""
    codes = np.zeros(len(padded) - ORDER + 1, np.uint64)
    for k in range(ORDER):
        codes = (codes << BYTE) | padded[k:len(padded) - ORDER + 1 + k].astype(np.uint64)
    return codes


def sequences(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of the five bytes that end at each place, and where each text begins in them. A text starts after line
    ends; one above ``SEGMENT`` bytes comes in parts."""
    lead = ORDER - 1
    if len(offsets) == 2 and len(data) > SEGMENT:
        padded = np.r_[np.full(lead, 10, np.uint8), data]
        for lo in range(0, len(data), SEGMENT):
            codes = _rolled(padded[lo:lo + SEGMENT + lead])
            yield codes, np.array([0, len(codes)])
    elif len(data):
        owner = np.repeat(np.arange(1, len(offsets)), np.diff(offsets))
        at = np.arange(len(data)) + lead * owner
        padded = np.full(len(data) + lead * (len(offsets) - 1), 10, np.uint8)
        padded[at] = data
        yield _rolled(padded)[at - lead], offsets


Counts = tuple[np.ndarray, np.ndarray, np.ndarray]


def _text_counts(data: np.ndarray, offsets: np.ndarray) -> Counts:
    """Distinct codes, how often each occurs, and how many of the texts hold it."""
    none = np.zeros(0, np.int64)
    if len(offsets) == 2:  # perhaps a long one in parts
        parts = [np.unique(codes, return_counts=True) for codes, _ in sequences(data, offsets)]
        found, n, _ = _added([(k, c, c) for k, c in parts]) if parts else (none.astype(np.uint64), none, none)
        return found, n, np.ones(len(found), np.int64)
    for codes, at in sequences(data, offsets):
        # At most 2**20 texts of a slice hold a byte, so their numbers fit above a code.
        lengths = np.diff(at)
        owner = np.repeat(np.arange((lengths > 0).sum(), dtype=np.uint64), lengths[lengths > 0])
        held, n = np.unique((owner << np.uint64(8 * ORDER)) | codes, return_counts=True)
        return _added([(held & MASKS[ORDER], n, np.ones(len(n), np.int64))])
    return none.astype(np.uint64), none, none


def _shard_of(codes: np.ndarray, shards: int) -> np.ndarray:
    return mix((codes >> BYTE) & MASKS[2]) % np.uint64(shards)


def _added(parts: list[Counts]) -> Counts:
    keys, *counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    found, at = np.unique(keys, return_inverse=True)
    return found, *[np.bincount(at, weights=n, minlength=len(found)).astype(np.int64) for n in counts]


def _counted(source: DataFrame) -> DataFrame:
    """``language, code, n, texts``: how often each sequence of five bytes occurs, and how many texts hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: dict[str, Counts] = {}
        waiting: dict[str, list[Counts]] = {}
        held = 0

        def settle() -> int:
            for name, parts in waiting.items():
                old = [gathered[name]] if name in gathered else []
                gathered[name] = _added(old + parts)
            waiting.clear()
            return sum(len(parts[0]) for parts in gathered.values())

        def given():
            for name, (keys, n, held_by) in gathered.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), keys.astype(np.int64), n, held_by],
                                                 ["language", "code", "n", "texts"])
            gathered.clear()

        for batch in batches:
            language = batch.column(batch.schema.get_field_index("language")).to_pylist()
            texts = text_column(batch)
            for name in sorted(set(language)):
                rows = pa.array([i for i, x in enumerate(language) if x == name])
                for _, _, data, offsets in text_slices(texts.take(rows)):
                    found = _text_counts(data, offsets)
                    waiting.setdefault(name, []).append(found)
                    held += len(found[0])
                    if held > GATHERED:
                        held = settle()
                        if held > GATHERED // 2:
                            yield from given()
                            held = 0
        settle()
        yield from given()

    return source.select("language", "text").mapInArrow(count, "language string, code long, n long, texts long") \
        .groupBy("language", "code").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))


def language_models(source: DataFrame, scratch: Scratch) -> DataFrame:
    """``language, shard, shards, seen, cost, size, pairs`` and arrays of each level: the shards of all models.

    ``cost`` over ``seen`` is what a byte of the language costs on average in the short model.
    """
    counts = scratch.keep(_counted(source), "counts")
    most = counts.groupBy("language").count().agg(F.max("count")).first()[0] or 0
    shards = max(1, -(-most // SHARD_KEYS))

    def shorter(df: DataFrame, order: int) -> DataFrame:
        return df.groupBy("language", F.col("code").bitwiseAND((1 << 8 * order) - 1).alias("code")).agg(
            F.count("*").alias("n"))

    short = counts.groupBy("language", F.col("code").bitwiseAND((1 << 24) - 1).alias("code")).agg(F.sum("n").alias("n"))
    five = counts.select("language", "code", F.col("texts").alias("n"))
    four = shorter(five.filter(F.col("n") >= LEAST_TEXTS), 4)
    times = None
    for order, df in ((0, short), (3, shorter(four, 3)), (4, four), (5, five)):
        few = df.filter("n <= 4").groupBy("language", F.lit(order).alias("order"), "n").agg(F.count("*").alias("times"))
        times = few if times is None else times.unionByName(few)
    base = shorter(short, 2).groupBy("language").cogroup(times.groupBy("language")).applyInPandas(
        _base, "language string, pairs binary, discounts array<double>")
    base = scratch.keep(base, "base").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(batch.schema.get_field_index("code")).to_numpy().astype(np.uint64)
            yield batch.append_column("shard", pa.array(_shard_of(codes, shards).astype(np.int32)))

    placed = counts.mapInArrow(place, "language string, code long, n long, texts long, shard int")
    arrays = ", ".join(f"{name}{k} binary" for k in ORDERS for name in LEVEL)
    return placed.groupBy("language", "shard").cogroup(base.groupBy("language", "shard")).applyInPandas(
        _shard, f"language string, shard int, seen long, cost long, size long, pairs binary, {arrays}") \
        .withColumn("shards", F.lit(shards))


#: Levels of a shard: that of the short model, and the orders of the long one.
ORDERS = (0, 3, 4, 5)
#: Arrays of a level: keys and their probabilities, contexts and what they leave to shorter sequences.
LEVEL = ("keys", "logs", "contexts", "left")
KINDS = (np.uint64, np.int32, np.uint64, np.int32)


class Shard(NamedTuple):
    """Probabilities of pairs, which both models end at, and the levels ``ORDERS``."""

    pairs: np.ndarray
    levels: list[tuple[np.ndarray, ...]]


def discounts_of(times: np.ndarray) -> np.ndarray:
    """What counts of one, two, and three or more give up, from how often the counts one to four occur."""
    n = np.maximum(times, 1)
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    # Discounts of tiny corpora can leave their range.
    return np.array([0.0, *[min(max(d, 0.1), k - 0.05) for k, d in zip((1, 2, 3), raw, strict=True)]])


def _times(counts: np.ndarray) -> np.ndarray:
    return np.array([(counts == k).sum() for k in range(1, 5)])


def _level(context: np.ndarray, counts: np.ndarray, size: int, discounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Discounted share of each entry in its context, and the mass each context leaves; 1 if it was never seen."""
    given = discounts[np.minimum(counts, 3)]
    total = np.bincount(context, weights=counts, minlength=size)
    left = np.bincount(context, weights=given, minlength=size)
    mass = np.divide(left, total, out=np.ones(size), where=total > 0)
    return (counts - given) / total[context], mass


def pair_probabilities(pairs: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of the second byte of each pair after the first; ``after`` is how many bytes are seen before a pair."""
    pairs = pairs.astype(np.int64)
    seen, before = np.unique(pairs & 0xFF, return_counts=True)
    share, mass = _level(np.zeros(len(seen), np.int64), before, 1, discounts_of(_times(before)))
    single = np.full(256, mass[0] / 256)
    single[seen] += share
    share, mass = _level(pairs >> 8, after, 256, discounts_of(_times(after)))
    out = np.repeat(mass, 256) * np.tile(single, 256)
    out[pairs] += share
    return out


def _base(pairs: pd.DataFrame, times: pd.DataFrame) -> pd.DataFrame:
    """Pairs of a language, and the discounts of each level."""
    found = pair_probabilities(pairs["code"].to_numpy(), pairs["n"].to_numpy())
    discounts = []
    for order in ORDERS:
        mine = times[times["order"] == order]
        n = np.zeros(4, np.int64)
        n[mine["n"].to_numpy() - 1] = mine["times"].to_numpy()
        discounts.extend(discounts_of(n))
    language = (pairs if len(pairs) else times)["language"].iloc[0]
    return pd.DataFrame({"language": [language], "pairs": [found.tobytes()], "discounts": [discounts]})


def shard_arrays(codes: np.ndarray, counts: np.ndarray, texts: np.ndarray, pairs: np.ndarray,
                 discounts: np.ndarray) -> Shard:
    """A shard from its sequences of five bytes, sorted, the probabilities of pairs, and discounts by level."""
    held = texts >= LEAST_TEXTS
    short, at = np.unique(codes & MASKS[3], return_inverse=True)
    entries = {0: (short, np.bincount(at, weights=counts, minlength=len(short)).astype(np.int64)), 5: (codes[held], texts[held])}
    for k in (4, 3):
        entries[k] = np.unique(entries[k + 1][0] & MASKS[k], return_counts=True)
    levels, below = [], None
    for k, given in zip(ORDERS, discounts, strict=True):
        keys, n = entries[k]
        contexts, which = np.unique(keys >> BYTE, return_inverse=True)
        share, mass = _level(which, n, len(contexts), given)
        lower = below[1][np.searchsorted(below[0], keys & MASKS[k - 1])] if k > 3 else pairs[(keys & MASKS[2]).astype(np.int64)]
        chance = share + mass[which] * lower
        below = keys, chance
        # No code is as large as the last key, so a search ends at a key at the latest.
        levels.append((np.r_[keys, END], np.r_[_scaled(chance), 0].astype(np.int32),
                       np.r_[contexts, END], np.r_[_scaled(mass), 0].astype(np.int32)))
    return Shard(_scaled(pairs), levels)


def _scaled(chance: np.ndarray) -> np.ndarray:
    return np.rint(-np.log2(chance) * SCALE).astype(np.int32)


def _shard(rows: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
    if not len(rows) or not len(base):
        return pd.DataFrame()
    rows = rows.sort_values("code")
    codes, counts = rows["code"].to_numpy().astype(np.uint64), rows["n"].to_numpy()
    shard = shard_arrays(codes, counts, rows["texts"].to_numpy(), np.frombuffer(base["pairs"].iloc[0]),
                         np.array(base["discounts"].iloc[0]).reshape(-1, 4))
    fields = {f"{name}{k}": [part.tobytes()] for k, level in zip(ORDERS, shard.levels, strict=True)
              for name, part in zip(LEVEL, level, strict=True)}
    size = shard.pairs.nbytes + sum(part.nbytes for level in shard.levels for part in level)
    return pd.DataFrame({"language": [rows["language"].iloc[0]], "shard": [rows["shard"].iloc[0]],
                         "seen": [int(counts.sum())], "cost": [int((costs(shard, codes)[0] * counts).sum())], "size": [size],
                         "pairs": [shard.pairs.tobytes()], **fields})


def costs(shard: Shard, codes: np.ndarray) -> np.ndarray:
    """What the last byte of each sequence costs after the others, in the short model and in the long one."""
    short = shard.pairs[(codes & MASKS[2]).astype(np.int64)].astype(np.int64)
    long = short.copy()
    for k, (keys, logs, contexts, left) in zip(ORDERS, shard.levels, strict=True):
        out = long if k else short
        mine = codes & MASKS[k or 3]
        context = mine >> BYTE
        at = np.searchsorted(contexts, context)
        out += np.where(contexts[at] == context, left[at], 0)
        at = np.searchsorted(keys, mine)
        hit = keys[at] == mine
        out[hit] = logs[at[hit]]
    return np.stack([short, long])


class Models:
    """Some shards of the models, as tasks hold them. ``usual`` has what a byte costs in every language that has a model."""

    def __init__(self, rows, usual: dict[str, float], shards: int, first: bool):
        self.usual, self.shards, self.first = usual, shards, first
        self.held: dict[str, dict[int, Shard]] = {}
        for r in rows:
            levels = [tuple(np.frombuffer(r[f"{name}{k}"], kind) for name, kind in zip(LEVEL, KINDS, strict=True))
                      for k in ORDERS]
            self.held.setdefault(r["language"], {})[r["shard"]] = Shard(np.frombuffer(r["pairs"], np.int32), levels)

    def costs(self, language: str, codes: np.ndarray) -> np.ndarray:
        """In both models, as far as the shards held here go. Without a model a byte costs eight bits."""
        out = np.zeros((2, len(codes)), np.int64)
        if language not in self.usual:
            return out + 8 * SCALE * self.first
        shards = _shard_of(codes, self.shards) if self.shards > 1 else None
        for number, shard in self.held.get(language, {}).items():
            if shards is None:
                return costs(shard, codes)
            mine = shards == number
            out[:, mine] = costs(shard, codes[mine])
        return out

    def own(self, data: np.ndarray, offsets: np.ndarray, languages: list[str]) -> np.ndarray:
        """What each text costs in its own language, in both models."""
        out = np.zeros((2, len(offsets) - 1), np.int64)
        for codes, at in sequences(data, offsets):
            names, which = np.unique(np.array(languages, object), return_inverse=True)
            owner = np.repeat(which, np.diff(at))
            places = np.zeros((2, len(codes)), np.int64)
            for k, name in enumerate(names):
                mine = owner == k
                found, back = np.unique(codes[mine], return_inverse=True)
                places[:, mine] = self.costs(name, found)[:, back]
            total = np.hstack([np.zeros((2, 1), np.int64), np.cumsum(places, axis=1)])
            out += total[:, at[1:]] - total[:, at[:-1]]
        return out

    def pieces(self, data: np.ndarray, offsets: np.ndarray, languages: list[str]) -> Iterator[tuple[np.ndarray, dict]]:
        """The text of each piece of ``PIECE`` bytes, and what the pieces cost in each language."""
        for codes, at in sequences(data, offsets):
            starts = [np.arange(a, b, PIECE) for a, b in zip(at[:-1], at[1:], strict=True)]
            cuts = np.concatenate(starts)
            found, back = np.unique(codes, return_inverse=True)
            yield np.repeat(np.arange(len(starts)), [len(s) for s in starts]), {
                name: np.add.reduceat(self.costs(name, found)[:, back], cuts, axis=1) for name in sorted({*languages, *self.usual})}

    def strays(self, cost: np.ndarray, lengths: np.ndarray, languages: list[str]) -> np.ndarray:
        usual = np.array([self.usual.get(x, 0.0) for x in languages])
        return (lengths > 0) & (cost > (usual + STRAY) * SCALE * lengths)

    def best(self, data: np.ndarray, offsets: np.ndarray, languages: list[str]) -> np.ndarray:
        """What each text costs if a text that strays is read piece by piece, each by the language that explains it
        best, so that a passage in another language isn't taken for noise."""
        out = self.own(data, offsets, languages)
        lengths = np.diff(offsets)
        stray = np.flatnonzero(self.strays(out[0], lengths, languages))
        if len(stray):
            again = np.zeros((2, len(stray)), np.int64)
            chosen = data[np.repeat(np.isin(np.arange(len(lengths)), stray), lengths)]
            for owner, found in self.pieces(chosen, np.r_[0, np.cumsum(lengths[stray])], [languages[i] for i in stray]):
                for model, least in enumerate(np.min(list(found.values()), axis=0)):
                    np.add.at(again[model], owner, least)
            out[:, stray] = again
        return out


def _scored(source: DataFrame, models: DataFrame, with_text: bool, scratch: Scratch) -> DataFrame:
    """Texts with their word counts and bits per byte. If the shards are more than a task may hold, the texts are
    written with a key and read once for each group of shards."""
    spark = source.sparkSession
    usual = {r["language"]: r["cost"] / r["seen"] / SCALE for r in models.groupBy("language").agg(
        F.sum("cost").alias("cost"), F.sum("seen").alias("seen")).collect()}  # a number for each language
    total, shards = models.agg(F.sum("size"), F.max("shards")).first()
    groups = max(1, -(-(total or 0) // MODEL_BYTES))

    def sent(g: int):
        mine = models.filter(F.expr(f"pmod(hash(language, shard), {groups}) = {g}")).collect()
        return spark.sparkContext.broadcast(Models(mine, usual, shards or 1, g == 0))

    row = source.schema["row"].dataType.simpleString()
    schema = f"row {row}, language string, {BASE}, length long" + ", text string" * with_text
    bits = [F.when(F.col("length") > 0, F.col(cost) / F.lit(SCALE) / F.col("length")).alias(name)
            for cost, name in (("cost", "bits"), ("long_cost", "long_bits"))]
    names = [c.split()[0] for c in BASE.split(", ")]
    text = ["text"] if with_text else []
    if groups == 1:
        return source.mapInArrow(_reader(with_text, sent(0)), schema + ", cost long, long_cost long") \
            .select("row", "language", *names, *bits, *text)
    texts = scratch.keep(source.withColumn("key", F.monotonically_increasing_id()), "texts")
    own = _gathered(texts, sent, groups, _own_costs, "key long, cost long, long_cost long", scratch, "own").groupBy("key") \
        .agg(F.sum("cost").alias("own"), F.sum("long_cost").alias("long_own"))
    counted = texts.mapInArrow(_reader(with_text, None), schema + ", key long").join(own, "key", "left")
    counted = scratch.keep(counted, "counted")
    ends = spark.createDataFrame(list(usual.items()), "language string, usual double")
    stray = counted.join(F.broadcast(ends), "language", "left").filter(  # a number for each language
        (F.col("length") > 0) & (F.col("own") > (F.coalesce("usual", F.lit(0.0)) + STRAY) * SCALE * F.col("length"))).select("key")
    again = _gathered(texts.join(stray, "key", "left_semi"), sent, groups, _piece_costs,
                      "key long, piece long, by string, cost long, long_cost long", scratch, "pieces")
    for by, add in ((["key", "piece", "by"], F.sum), (["key", "piece"], F.min), (["key"], F.sum)):
        again = again.groupBy(*by).agg(*[add(c).alias(c) for c in ("cost", "long_cost")])
    return counted.join(again, "key", "left").withColumns(
        {"cost": F.coalesce("cost", "own"), "long_cost": F.coalesce("long_cost", "long_own")}) \
        .select("row", "language", *names, *bits, *text)


def _gathered(texts: DataFrame, sent, groups: int, run, schema: str, scratch: Scratch, name: str) -> DataFrame:
    """What ``run`` gives for each group of shards, one after the other, so that only one lies in memory."""
    out = None
    for g in range(groups):
        models = sent(g)
        part = scratch.keep(texts.select("key", "language", "text").mapInArrow(run(models), schema), f"{name}{g}")
        models.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def _own_costs(models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, language = (batch.column(batch.schema.get_field_index(c)) for c in ("key", "language"))
            for first, after, data, offsets in text_slices(text_column(batch)):
                n = after - first
                cost = models.value.own(data, offsets, language.slice(first, n).to_pylist())
                yield pa.RecordBatch.from_arrays([key.slice(first, n), *map(pa.array, cost)], ["key", "cost", "long_cost"])
    return run


def _piece_costs(models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("key")).to_numpy()
            language = batch.column(batch.schema.get_field_index("language")).to_pylist()
            for first, after, data, offsets in text_slices(text_column(batch)):
                done = np.zeros(after - first, np.int64)  # pieces of each text in the parts before
                for owner, found in models.value.pieces(data, offsets, language[first:after]):
                    counts = np.bincount(owner, minlength=after - first)
                    piece = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + done[owner]
                    done += counts
                    for name, cost in found.items():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys[first + owner]), pa.array(piece), pa.array([name] * len(owner)), *map(pa.array, cost)],
                            ["key", "piece", "by", "cost", "long_cost"])
    return run


def _reader(with_text: bool, models):
    """Word counts and lengths of texts; with ``models`` also their costs, else their keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch)
            language, row = (batch.column(batch.schema.get_field_index(c)) for c in ("language", "row"))
            for first, after, data, offsets in text_slices(texts):
                n = after - first
                mine = language.slice(first, n)
                fields = [row.slice(first, n), mine, *base_counts(data, offsets), np.diff(offsets)]
                labels = ["row", "language", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          "base_failed", "length"]
                if with_text:
                    fields.append(texts.slice(first, n))
                    labels.append("text")
                if models is None:
                    fields.append(batch.column(batch.schema.get_field_index("key")).slice(first, n))
                    labels.append("key")
                else:
                    fields.extend(models.value.best(data, offsets, mine.to_pylist()))
                    labels.extend(["cost", "long_cost"])
                yield pa.RecordBatch.from_arrays(fields, labels)
    return run


def base_counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The columns of ``BASE`` for texts laid end to end."""
    words = Words(data, offsets)
    n_words = words.counts.astype(np.int64)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(flags)][offsets])

    begins = (data & 0xC0) != 0x80
    white = per_text(np.isin(data, np.array([9, 10, 11, 12, 13, 32], np.uint8)))
    raw = data.tobytes()
    dup_lines = np.zeros(len(n_words), np.int64)
    for i in range(len(n_words)):
        lines = [x for x in raw[offsets[i]:offsets[i + 1]].split(b"\n") if x.strip()]
        dup_lines[i] = len(lines) - len(set(lines))
    repeated = np.diff(np.r_[0, np.cumsum(_in_repeats(words))][words.first])
    failed = (n_words < MIN_WORDS) | (100 * repeated > REPEAT_PERCENT * n_words)
    return [n_words, per_text(begins) - white, per_text(SYMBOLS[data]), dup_lines, repeated, failed]


def _in_repeats(words: Words, size: int = 3) -> np.ndarray:
    """Which words lie in a window of three that its text holds twice."""
    covered = np.zeros(len(words.hashes), bool)
    gram = grams(words.hashes, size)
    if not len(gram):
        return covered
    owner = words.owners()
    inside = owner[:len(gram)] == owner[size - 1:]
    own = mix(gram ^ mix(owner[:len(gram)].astype(np.uint64) + np.uint64(1)))[inside]
    _, inverse, counts = np.unique(own, return_inverse=True, return_counts=True)
    at = np.flatnonzero(inside)[counts[inverse] > 1]
    for j in range(size):
        covered[at + j] = True
    return covered
