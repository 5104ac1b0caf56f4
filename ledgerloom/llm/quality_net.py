"""A quality classifier: a small convolutional network over bytes, in numpy.

A text is laid out in blocks of ``BLOCK`` bytes; two neighbouring blocks form a chunk, so
chunks overlap by half and cover the whole text. Every byte has a learned vector; learned
filters of ``WIDTH`` bytes are applied at every second byte, and the highest value of each
filter in a chunk is kept (max-pooling). Highest and mean values over the chunks and the
logarithm of the length pass one hidden layer and give one probability.

The network is fitted on the driver to about ``SAMPLE_PER_LABEL`` labelled documents a label
(chosen by a hash of the id) of at most ``FIT_BYTES`` bytes each, which bounds its memory;
longer labelled documents are left out of the fit only. Labels are joined by a broadcast of
that bounded sample. Every whole text is then scored in one pass, unshuffled, whatever its length.

Defined cases: null and empty texts are scored as a text without bytes; without labels of
both kinds the score is the share of label 1 (0.5 if there is none); repeated rows are
scored each. Memory of a task follows ``text.PIECE_BYTES`` or the longest single text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import as_rows, flat_bytes, labelled_sample, remainder, row_pieces

BLOCK, WIDTH, STRIDE = 256, 8, 2
BYTE_VECTOR, FILTERS, HIDDEN = 4, 16, 16
SAMPLE_PER_LABEL, FIT_BYTES = 1_000, 20_000
EPOCHS, BATCH, RATE, DECAY = 14, 32, 0.01, 1e-4
GOOD_PER_BAD = 3
"""Texts of label 1 drawn for each of label 0 while fitting."""
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
_PAD = 256
_RUN_BLOCKS = 2_048


def layout(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes in whole blocks per text, each after ``WIDTH`` empty places so that no filter sees two texts; block offsets of the texts."""
    blocks = (WIDTH + np.diff(edges) + BLOCK - 1) // BLOCK
    offsets = np.concatenate(([0], np.cumsum(blocks)))
    codes = np.full(offsets[-1] * BLOCK + WIDTH, _PAD, np.int16)
    codes[np.arange(len(data)) + np.repeat(offsets[:-1] * BLOCK + WIDTH - edges[:-1], np.diff(edges))] = data
    return codes, offsets


class ByteNet:
    """The weights, the forward pass and its gradient."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.vectors = rng.normal(0, 0.5, (257, BYTE_VECTOR)).astype(np.float32)
        self.vectors[_PAD] = 0
        self.filters = rng.normal(0, (WIDTH * BYTE_VECTOR) ** -0.5, (WIDTH * BYTE_VECTOR, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.inner = rng.normal(0, (2 * FILTERS) ** -0.5, (2 * FILTERS + 1, HIDDEN)).astype(np.float32)
        self.inner_bias = np.zeros(HIDDEN, np.float32)
        self.out = rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32)
        self.base = np.zeros(1, np.float32)
        self.constant: float | None = None

    def weights(self) -> dict[str, np.ndarray]:
        return {n: getattr(self, n) for n in ("vectors", "filters", "bias", "inner", "inner_bias", "out", "base")}

    def _windows(self, codes: np.ndarray) -> np.ndarray:
        """The filter inputs of every second byte, a row each."""
        seen = self.vectors[codes]
        count = (len(codes) - WIDTH) // STRIDE
        step = seen.strides[0]
        view = np.lib.stride_tricks.as_strided(seen, (count, WIDTH * BYTE_VECTOR), (step * STRIDE, seen.strides[1]))
        return view

    def block_peaks(self, codes: np.ndarray, where: bool = False):
        """The highest response of each filter in each block (and its place)."""
        total = (len(codes) - WIDTH) // BLOCK
        peaks = np.empty((total, FILTERS), np.float32)
        places = np.empty((total, FILTERS), np.int64) if where else None
        per = BLOCK // STRIDE
        for low in range(0, total, _RUN_BLOCKS):
            high = min(total, low + _RUN_BLOCKS)
            response = (self._windows(codes[low * BLOCK : high * BLOCK + WIDTH]) @ self.filters).reshape(high - low, per, FILTERS)
            peaks[low:high] = response.max(axis=1)
            if where:
                places[low:high] = response.argmax(axis=1) * STRIDE + (np.arange(low, high) * BLOCK)[:, None]
        return peaks, places

    def _pooled(self, peaks: np.ndarray, offsets: np.ndarray, edges: np.ndarray):
        """Chunk maxima of both neighbours, then highest, mean and length of each text."""
        follow = np.concatenate((peaks[1:], peaks[-1:]))
        last = offsets[1:] - 1
        follow[last] = peaks[last]
        chunk = np.maximum(np.maximum(peaks, follow) + self.bias, 0)
        sizes = np.diff(offsets)[:, None]
        top = np.maximum.reduceat(chunk, offsets[:-1], axis=0)
        mean = np.add.reduceat(chunk, offsets[:-1], axis=0) / sizes
        length = np.log1p(np.diff(edges)).astype(np.float32)[:, None] / 4
        return follow, chunk, np.concatenate((top, mean, length), axis=1)

    def _hidden(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled @ self.inner + self.inner_bias, 0)

    def score(self, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """The probability of label 1 of each text."""
        if self.constant is not None or len(edges) < 2:
            return np.full(len(edges) - 1, self.constant or 0.0)
        codes, offsets = layout(data, edges)
        logit = self._hidden(self._pooled(self.block_peaks(codes)[0], offsets, edges)[2]) @ self.out + self.base
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -30, 30)))

    def gradient(self, data: np.ndarray, edges: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """The gradient of the mean log loss over the texts."""
        codes, offsets = layout(data, edges)
        peaks, places = self.block_peaks(codes, where=True)
        follow, chunk, pooled = self._pooled(peaks, offsets, edges)
        hidden = self._hidden(pooled)
        probability = 1 / (1 + np.exp(-np.clip(hidden @ self.out + self.base, -30, 30)))
        d_logit = ((probability - labels) / len(labels)).astype(np.float32)
        texts = np.repeat(np.arange(len(labels)), np.diff(offsets))
        d_hidden = np.where(hidden > 0, d_logit[:, None] * self.out[None, :], 0)
        d_pooled = d_hidden @ self.inner.T
        is_top = (chunk == pooled[texts, :FILTERS]) & (chunk > 0)
        ties = np.maximum(np.add.reduceat(is_top.astype(np.float32), offsets[:-1], axis=0), 1)
        d_chunk = is_top * (d_pooled[:, :FILTERS] / ties)[texts] + (d_pooled[:, FILTERS : 2 * FILTERS] / np.diff(offsets)[:, None])[texts]
        d_chunk = np.where(chunk > 0, d_chunk, 0).astype(np.float32)
        # A chunk's maximum is in its own block or in the following one.
        mine = peaks >= follow
        d_peak = np.where(mine, d_chunk, 0)
        d_peak[1:] += np.where(mine, 0, d_chunk)[:-1]
        used = np.nonzero(d_peak)
        at, which, amount = places[used], used[1], d_peak[used]
        span = codes[at[:, None] + np.arange(WIDTH)]
        inputs = self.vectors[span].reshape(len(at), -1)
        d_filters = np.zeros_like(self.filters)
        for f in range(FILTERS):
            own = which == f
            d_filters[:, f] = amount[own] @ inputs[own]
        d_inputs = (self.filters[:, which] * amount).T.reshape(len(at), WIDTH, BYTE_VECTOR)
        d_vectors = np.zeros_like(self.vectors)
        np.add.at(d_vectors, span, d_inputs)
        d_vectors[_PAD] = 0
        return {"vectors": d_vectors, "filters": d_filters, "bias": d_chunk.sum(axis=0), "inner": pooled.T @ d_hidden,
                "inner_bias": d_hidden.sum(axis=0), "out": hidden.T @ d_logit, "base": d_logit.sum(keepdims=True)}


def fit(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> ByteNet:
    """A network fitted with Adam; an epoch draws ``GOOD_PER_BAD`` texts of label 1 for each of label 0."""
    net, labels = ByteNet(seed), np.asarray(labels, np.float32)
    if len(set(labels.tolist())) < 2:
        net.constant = float(labels.mean()) if len(labels) else 0.5
        return net
    rng = np.random.default_rng(seed)
    groups = [np.flatnonzero(labels == v) for v in (0, 1)]
    bad = max(len(groups[0]), -(-len(groups[1]) // GOOD_PER_BAD))
    first = {n: np.zeros_like(w) for n, w in net.weights().items()}
    second = {n: np.zeros_like(w) for n, w in net.weights().items()}
    step = 0
    for epoch in range(EPOCHS):
        drawn = [np.concatenate([rng.permutation(g) for _ in range(-(-size // len(g)))])[:size] for g, size in zip(groups, (bad, bad * GOOD_PER_BAD))]
        order = np.concatenate((drawn[0][:, None], drawn[1].reshape(bad, GOOD_PER_BAD)), axis=1).ravel()
        rate = RATE * (1 - epoch / EPOCHS) + RATE / 20
        for low in range(0, len(order), BATCH):
            some = order[low : low + BATCH]
            data = np.frombuffer(b"".join(texts[i] for i in some), np.uint8)
            edges = np.cumsum([0, *[len(texts[i]) for i in some]])
            step += 1
            for name, grad in net.gradient(data, edges, labels[some]).items():
                weight = getattr(net, name)
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.99 * second[name] + 0.01 * grad * grad
                weight -= rate * (first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-7) + DECAY * weight)
    return net


def learn_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", per_label: int = SAMPLE_PER_LABEL) -> ByteNet:
    """Fit a network to a bounded sample of the labelled documents given."""
    rows = labelled_sample(docs, labels, label, doc_id, text, per_label, FIT_BYTES).toPandas().sort_values(["label", "_id", "text"])
    return fit([t.encode() for t in rows["text"]], rows["label"].to_numpy())


def score_quality(docs: DataFrame, net: ByteNet, text: str = "text") -> DataFrame:
    """``row`` (the document as it came) and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = as_rows(docs)

    def score(batches):
        for batch in batches:
            for piece, texts in row_pieces(batch, text):
                yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(shared.value.score(*flat_bytes(texts)), pa.float64())], ["row", "score"])

    return rows.mapInArrow(score, rows.select("row", F.lit(0.0).alias("score")).schema)


def quality_report(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from labels that are not held out, then score every document."""
    net = learn_quality(docs, labels.where(remainder(doc_id, FOLDS) != HELD_OUT), doc_id, text)
    scored = score_quality(docs.select(doc_id, text), net, text).select(F.col(f"row.{doc_id}").alias(doc_id), "score")
    return scored.select(doc_id, (remainder(doc_id, FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
