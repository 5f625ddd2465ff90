"""Removal of byte strings that start in more than one place, by a radix sort that stops at the threshold.

Suffixes are compared only up to ``LENGTH`` bytes, most significant digits first. Groups of one leave the sort, and a
group of equal suffixes at the last digit is exactly a repeated window.

Neighbouring suffixes travel together. The windows of ``LENGTH`` bytes whose smallest hash of ``ANCHOR`` bytes lies at
one place form a run, a row each instead of one row for each byte. What the windows of a run have in common is its
first digit, and each pass halves runs into shorter ones with more in common: the anchor, then the bytes that ``STEP``
neighbouring windows share, then the whole window. In each pass, runs equal in everything they cover are one class:
if the class has two places, all its windows are repeated, and one place stands for it in the next pass. So copies,
however many, meet in counts and never in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvec.llm.tables import Scratch, arrays, keyed, lists, signed
from quillvec.llm.words import (anchored_runs, byte_grams, merged, mix, overlapping, text_column, text_slices)

LENGTH = 400
ANCHOR = 128
#: Neighbouring windows that stay together in the second pass.
STEP = 16
#: Bytes of text in one work array.
PART = 1 << 20
RUNS = "key long, near int, far int, whole long, id long, sub long, place int"
#: What tells classes of one group apart: the distances of the run's first and last window, and all its bytes.
CLASS = ["key", "near", "far", "whole"]


def without_repeats(docs: DataFrame, length: int = LENGTH, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each text without the bytes covered by a string of ``length`` bytes that also starts anywhere else.

    Returns ``doc_id`` and the columns in ``carry``, with ``n_bytes``, ``n_removed``, ``spans`` (maximal removed runs of
    bytes, half-open) and ``kept`` (the remaining bytes, which need not be whole characters). All places of a
    repeated string lose it. Strings never cross texts and are judged on the input; they may overlap.

    A NULL text counts as empty. A NULL ``doc_id`` comes back as NULL; such texts are told apart by content. Equal rows
    are places of their own, so a text given twice is removed. Texts shorter than ``length`` stay whole. Other columns
    are left out.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    source = keyed(docs, *carry)
    repeated, standing = _pass(anchored(source, length), "anchor", scratch)
    slices = scratch.keep(_slices(source, standing, length), "slices")
    steps, standing = _pass(_digits(slices, length, STEP), "step", scratch)
    parts = slices.select("id", "sub", "place", F.col("near").alias("least"), "base", "bytes") \
        .join(standing, ["id", "sub", "place"]).filter("near >= least AND far <= base")
    windows, _ = _pass(_digits(parts, length, 1), "window", scratch)
    spans = repeated.unionByName(steps).unionByName(windows).groupBy("id", "sub").agg(F.collect_list(F.struct(
        (F.col("place") - F.col("far")).alias("lo"),
        (F.col("place") - F.col("near") + length).alias("hi"))).alias("found"))
    row = source.schema["row"].dataType.simpleString()
    out = source.join(spans, ["id", "sub"], "left").select("row", "text", "found").mapInArrow(
        _cut, f"row {row}, n_bytes long, n_removed long, spans array<struct<lo:int,hi:int>>, kept binary")
    return out.select("row.*", "n_bytes", "n_removed", "spans", "kept")


def _pass(runs: DataFrame, name: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """One digit: ``(runs whose windows all are repeated, one run of each class of groups that go on)``.

    Groups with one row leave. The second result has ``id, sub, place, near, far`` and the group's ``key``.
    """
    # Tables of their own, so that the join of a very frequent key can be split.
    groups = scratch.keep(runs.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"),
                          f"{name}-groups")
    found = scratch.keep(runs.join(groups, "key", "left_semi"), f"{name}-found")
    classes = scratch.keep(found.groupBy(*CLASS).agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in (
        "id", "sub", "place")]), f"{name}-classes")
    copies = classes.filter("n > 1").select(*CLASS)
    repeated = scratch.keep(found.join(copies, CLASS, "left_semi").select("id", "sub", "place", "near", "far"),
                            f"{name}-repeated")
    several = scratch.keep(classes.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"),
                           f"{name}-several")
    standing = scratch.keep(classes.join(several, "key", "left_semi").select("id", "sub", "place", "near", "far", "key"),
                            f"{name}-standing")
    scratch.drop(f"{name}-groups", f"{name}-found", f"{name}-classes", f"{name}-several")
    return repeated, standing


def anchored(source: DataFrame, length: int = LENGTH) -> DataFrame:
    """Runs of windows with one anchor, as ``RUNS``.

    ``key`` stands for the anchor, ``place`` is where it begins, ``near`` and ``far`` are its distances from the last
    and the first window of the run, and ``whole`` stands for all bytes of the run.
    """
    size = 1 << (min(ANCHOR, length).bit_length() - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, subs = arrays(batch, "id", "sub")
            for first, _, data, offsets in text_slices(text_column(batch), PART):
                owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                ends = offsets[1:][owner]
                for lo, hi in overlapping(owner, length, PART):
                    part = data[lo:hi]
                    gram = byte_grams(part, size)
                    place, head, tail = anchored_runs(gram, ends[lo:hi] - lo, length, size)
                    if not len(place):
                        continue
                    raw = part.tobytes()
                    whole = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(
                        head.tolist(), (tail + length).tolist(), strict=True)), np.uint64, len(head))
                    doc = owner[head + lo]
                    yield pa.RecordBatch.from_arrays(
                        [signed(gram[place]), (place - tail).astype(np.int32), (place - head).astype(np.int32),
                         signed(whole), ids[first + doc], subs[first + doc],
                         (place + lo - offsets[doc]).astype(np.int32)],
                        ["key", "near", "far", "whole", "id", "sub", "place"])

    return source.select("id", "sub", "text").mapInArrow(run, RUNS)


def _slices(source: DataFrame, standing: DataFrame, length: int) -> DataFrame:
    """The bytes of the runs that go on: ``id, sub, place, key, near, far, base, bytes``. ``bytes`` begin ``base``
    bytes before the anchor."""
    runs = standing.groupBy("id", "sub").agg(F.collect_list(F.struct("place", "near", "far", "key")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, subs = arrays(batch, "id", "sub")
            at, fields = lists(batch.column(batch.schema.get_field_index("runs")))
            for first, after, data, offsets in text_slices(text_column(batch), PART):
                raw = data.tobytes()
                for a in range(int(at[first]), int(at[after]), 10_000):
                    b = min(a + 10_000, int(at[after]))
                    doc = np.searchsorted(at, np.arange(a, b), "right") - 1
                    place, near, far = (fields[c][a:b] for c in ("place", "near", "far"))
                    start = offsets[doc - first] + place - far
                    end = offsets[doc - first] + place - near + length
                    yield pa.RecordBatch.from_arrays(
                        [ids[doc], subs[doc], place, fields["key"][a:b], near, far, far,
                         pa.array([raw[s:e] for s, e in zip(start.tolist(), end.tolist(), strict=True)], pa.binary())],
                        ["id", "sub", "place", "key", "near", "far", "base", "bytes"])

    return source.select("id", "sub", "text").join(runs, ["id", "sub"]).mapInArrow(
        run, "id long, sub long, place int, key long, near int, far int, base int, bytes binary")


def _digits(slices: DataFrame, length: int, step: int) -> DataFrame:
    """The next digit: runs cut into those of at most ``step`` windows, filed under what all windows there share.

    Cuts lie at fixed distances from the anchor, so equal windows fall into the same part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, subs, places, groups, nears, fars, bases = arrays(
                batch, "id", "sub", "place", "key", "near", "far", "base")
            texts = batch.column(batch.schema.get_field_index("bytes")).to_pylist()
            rows, keys, near, far, whole = [], [], [], [], []
            for k, raw in enumerate(texts):
                begin, a, b = int(bases[k]), int(nears[k]), int(fars[k])
                for cut in range(a - a % step, b + 1, step):
                    lo, hi = max(a, cut), min(b, cut + step - 1)
                    # All windows at distances cut to cut + step - 1 hold these bytes.
                    inner = raw[begin - cut:begin - cut - step + 1 + length]
                    rows.append(k)
                    keys.append(xxhash.xxh3_64_intdigest(inner, cut))
                    near.append(lo)
                    far.append(hi)
                    whole.append(xxhash.xxh3_64_intdigest(raw[begin - hi:begin - lo + length]))
            if rows:
                key = mix(np.array(keys, np.uint64) ^ groups[rows].view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [signed(key), np.array(near, np.int32), np.array(far, np.int32), signed(np.array(whole, np.uint64)),
                     ids[rows], subs[rows], places[rows]], ["key", "near", "far", "whole", "id", "sub", "place"])

    return slices.select("id", "sub", "place", "key", "near", "far", "base", "bytes").mapInArrow(run, RUNS)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans_type = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
    for batch in batches:
        at, fields = lists(batch.column(batch.schema.get_field_index("found")))
        for first, after, data, offsets in text_slices(text_column(batch)):
            raw = data.tobytes()
            kept, spans, n_removed = [], [], []
            for i in range(after - first):
                whole = raw[offsets[i]:offsets[i + 1]]
                mine = slice(at[first + i], at[first + i + 1])
                lo, hi = merged(fields["lo"][mine], fields["hi"][mine])
                lo, hi = lo.tolist(), hi.tolist()
                kept.append(b"".join(whole[a:b] for a, b in zip([0, *hi], [*lo, len(whole)], strict=True)))
                spans.append([{"lo": a, "hi": b} for a, b in zip(lo, hi, strict=True)])
                n_removed.append(sum(hi) - sum(lo))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("row")).slice(first, after - first),
                 np.diff(offsets), np.array(n_removed, np.int64), pa.array(spans, spans_type), pa.array(kept, pa.binary())],
                ["row", "n_bytes", "n_removed", "spans", "kept"])
