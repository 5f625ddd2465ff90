"""Quality classifier: a small byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover all of it. Filters over embedded bytes slide along each chunk, and
each filter keeps its largest answer. The largest and the mean answer over all chunks of a text go into one
probability, so neither the length of a text nor the place of a passage matters.

The network is fitted on the driver to a sample of labelled rows that has a fixed size. Each of ``DRAWS`` draws holds
other chunks of a text, spread over its whole length, and the network goes through the draws in turn for a fixed number of
steps, however small the sample. Scoring reads every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillvec.llm.words import text_column, text_slices

#: Bytes of a chunk, and from one chunk to the next.
CHUNK, HOP = 512, 384
#: Bytes that a filter sees, and from one place of it to the next.
WIDTH, STRIDE = 8, 4
EMBEDDING, FILTERS = 8, 32
#: Labelled rows that the network learns from at most, draws of chunks, and chunks of a text that a step reads.
SAMPLE_ROWS, DRAWS, DRAW_CHUNKS = 3000, 8, 6
STEPS, BATCH, RATE = 400, 64, 0.004
#: Bytes of text scored at a time.
PART = 1 << 19
THRESHOLD = 0.7
#: Stands for the places behind the end of a text.
PADDING = 256


def held_out(doc_id: Column) -> Column:
    """Whether the labels of a row are set aside: a quarter of all rows, by the checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def chunk_starts(length: int) -> np.ndarray:
    """Where the chunks of a text begin; an empty one has one chunk of padding."""
    return np.arange(0, max(1, length - (CHUNK - HOP)), HOP)


def chunks_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of bytes for each chunk, with padding beyond the end of its text."""
    place = starts[:, None] + np.arange(CHUNK)
    inside = place < ends[:, None]
    if not len(data):
        return np.full(place.shape, PADDING, np.int16)
    return np.where(inside, data[np.minimum(place, len(data) - 1)].astype(np.int16), np.int16(PADDING))


class Network:
    """Embedding, filters with their largest answers, and a linear end."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.5, (PADDING + 1, EMBEDDING)).astype(np.float32)
        self.embedding[PADDING] = 0
        self.filters = rng.normal(0, (WIDTH * EMBEDDING) ** -0.5, (WIDTH * EMBEDDING, FILTERS)).astype(np.float32)
        self.shift = np.zeros(FILTERS, np.float32)
        self.end = np.zeros(2 * FILTERS, np.float32)
        self.bias = np.zeros(1, np.float32)

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.shift, self.end, self.bias]

    def answers(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest answer of each filter in each chunk, and where it was given."""
        places = np.arange(0, CHUNK - WIDTH + 1, STRIDE)
        seen = self.embedding[chunks].reshape(len(chunks), CHUNK * EMBEDDING)
        windows = np.lib.stride_tricks.sliding_window_view(seen, WIDTH * EMBEDDING, axis=1)[:, places * EMBEDDING]
        out = windows.reshape(-1, WIDTH * EMBEDDING) @ self.filters
        out = out.reshape(len(chunks), len(places), FILTERS)
        at = out.argmax(axis=1)
        largest = np.take_along_axis(out, at[:, None, :], axis=1)[:, 0] + self.shift
        return np.maximum(largest, 0), places[at]

    def pooled(self, largest: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Largest and mean answers of each text, whose chunks begin at ``first``."""
        counts = np.diff(np.r_[first, len(largest)])[:, None]
        return np.hstack([np.maximum.reduceat(largest, first), np.add.reduceat(largest, first) / counts])

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(pooled @ self.end + self.bias, -30, 30)))

    def gradients(self, chunks: np.ndarray, first: np.ndarray, labels: np.ndarray, weights: np.ndarray):
        """Of the weighted log loss. Only the place where a filter answered most passes anything back."""
        largest, at = self.answers(chunks)
        pooled = self.pooled(largest, first)
        wrong = ((self.probability(pooled) - labels) * weights / len(labels)).astype(np.float32)
        counts = np.diff(np.r_[first, len(chunks)])
        owner = np.repeat(np.arange(len(first)), counts)
        back = wrong[:, None] * self.end
        most = largest == pooled[owner, :FILTERS]
        share = most / np.add.reduceat(most.astype(np.float32), first)[owner]
        passed = back[owner, :FILTERS] * share + (back[:, FILTERS:] / counts[:, None])[owner]
        passed = np.where(largest > 0, passed, 0).astype(np.float32)
        seen = chunks[np.arange(len(chunks))[:, None, None], at[:, :, None] + np.arange(WIDTH)]
        inputs = self.embedding[seen].reshape(len(chunks), FILTERS, WIDTH * EMBEDDING)
        filters = np.einsum("cf,cfk->kf", passed, inputs)
        to_bytes = passed[:, :, None] * self.filters.T
        embedding = np.zeros_like(self.embedding)
        np.add.at(embedding, seen.ravel(), to_bytes.reshape(-1, EMBEDDING))
        embedding[PADDING] = 0
        return [embedding, filters, passed.sum(axis=0), pooled.T @ wrong, wrong.sum(keepdims=True)]


def fit(samples: list[tuple[list[bytes], int]], seed: int = 5) -> Network:
    """A network fitted to ``(draws of chunks laid end to end, label)``, each row by the rarity of its label, and put
    right for that at the end, so that scores are shares of good texts again. The result depends on nothing but the
    samples and their order. Without samples every text scores one half."""
    network = Network(seed)
    if not samples:
        return network
    labels = np.array([label for _, label in samples], np.float32)
    shares = np.maximum(np.bincount(labels.astype(int), minlength=2) / len(labels), 0.02)
    weights = (0.5 / shares[labels.astype(int)]).astype(np.float32)
    rng = np.random.default_rng(seed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parts]
    order, turn = np.zeros(0, np.int64), -1
    for step in range(1, STEPS + 1):
        if not len(order):
            order, turn = rng.permutation(len(samples)), turn + 1
        mine, order = order[:BATCH], order[BATCH:]
        rows = [np.frombuffer(samples[i][0][turn % len(samples[i][0])], np.uint8).reshape(-1, CHUNK + 2) for i in mine]
        first = np.cumsum([0, *[len(r) for r in rows[:-1]]])
        found = network.gradients(_padded(np.concatenate(rows)), first, labels[mine], weights[mine])
        for part, grad, (mean, square) in zip(network.parts, found, moments, strict=True):
            mean += 0.1 * (grad - mean)
            square += 0.01 * (grad * grad - square)
            part -= RATE * (1 - step / STEPS) * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-7)
    network.bias += np.log(shares[1] / shares[0]).astype(np.float32)
    return network


def _packed(chunks: np.ndarray) -> np.ndarray:
    """Chunks as bytes, each after the number of its bytes that are no padding."""
    length = (chunks != PADDING).sum(axis=1)
    return np.hstack([length[:, None] >> 8, length[:, None] & 255, np.where(chunks == PADDING, 0, chunks)]).astype(np.uint8)


def _padded(rows: np.ndarray) -> np.ndarray:
    length = rows[:, 0].astype(np.int64) << 8 | rows[:, 1]
    return np.where(np.arange(CHUNK) < length[:, None], rows[:, 2:].astype(np.int16), np.int16(PADDING))


def drawn(starts: np.ndarray, draw: int) -> np.ndarray:
    """The chunks of one draw. Together the draws hold all chunks of a text with at most ``DRAWS * DRAW_CHUNKS``; of a longer
    one each takes as many, from places between those of the others."""
    if len(starts) <= DRAW_CHUNKS:
        return starts
    number = DRAWS * DRAW_CHUNKS
    at = np.arange(draw, max(number, 1), DRAWS)
    return starts[np.unique(at * len(starts) // number)]


def training_sample(docs: DataFrame, labels: DataFrame) -> list[tuple[list[bytes], int]]:
    """Draws of chunks and label of at most ``SAMPLE_ROWS`` labelled rows outside the held-out quarter, the first by a
    hash of their ids.

    A NULL text is an empty one. Rows without a label or an id have no part, and of several labels of one id the best
    counts. Of repeated rows with one id all have a part, as far as ``SAMPLE_ROWS`` goes. Without labels the list is empty.
    """
    chosen = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("quality").alias("label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = []
            for text in text_column(batch).to_pylist():
                data = np.frombuffer((text or "").encode(), np.uint8)
                starts = chunk_starts(len(data))
                draws = [drawn(starts, k) for k in range(DRAWS if len(starts) > DRAW_CHUNKS else 1)]
                raws.append([_packed(chunks_of(data, s, np.full(len(s), len(data)))).tobytes() for s in draws])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), batch.column(batch.schema.get_field_index("label")),
                 pa.array(raws, pa.list_(pa.binary()))], ["doc_id", "label", "chunks"])

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most SAMPLE_ROWS rows
    rows = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"), "text") \
        .mapInArrow(take, "doc_id long, label int, chunks array<binary>").orderBy("doc_id", "chunks").limit(SAMPLE_ROWS)
    return [([bytes(c) for c in r["chunks"]], min(1, max(0, r["label"]))) for r in rows.collect()]


def quality_scores(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id, score`` of every row: how likely its whole text is good, from 0 to 1.

    Nothing but the text counts. A NULL text scores as an empty one does. A NULL ``doc_id`` comes back as NULL, and repeated
    rows come back each time. Other columns are left out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for first, after, data, offsets in text_slices(text_column(batch), PART):
                yield pa.RecordBatch.from_arrays([ids.slice(first, after - first), text_scores(
                    sent.value, data, offsets)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def text_scores(network: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    starts = [chunk_starts(n) for n in np.diff(offsets).tolist()]
    counts = np.array([len(s) for s in starts])
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), counts)
    at = np.concatenate(starts) + offsets[owner]
    ends = offsets[owner + 1]
    size = PART // CHUNK
    largest = np.concatenate([network.answers(chunks_of(data, at[k:k + size], ends[k:k + size]))[0]
                              for k in range(0, len(at), size)])
    return network.probability(network.pooled(largest, first)).astype(np.float64)
