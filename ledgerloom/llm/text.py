"""Helpers that several operators share: Arrow texts as flat bytes, words, splits, samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

PIECE_BYTES = 1_000_000
"""Texts are worked on in runs of whole rows of about this many bytes, so memory does not follow the Arrow batch."""


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array and the offsets of the rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(edges):
        edges = np.zeros(1, dtype=np.int64)
    every = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return every[edges[0] : edges[-1]], edges - edges[0]


def _runs(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``limit`` bytes, as the first and the number of its texts."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield first, last - first
        first = last


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``limit`` bytes: the rows, their flat text, their offsets."""
    texts = batch.column(column)
    for first, count in _runs(texts, limit):
        yield batch.slice(first, count), *flat_bytes(texts.slice(first, count))


def as_rows(docs: DataFrame) -> DataFrame:
    """All columns in one, ``row``: they keep apart from added ones, and a text goes to Python once."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def row_pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of rows made by ``as_rows``, and their texts (null counts as empty)."""
    texts = batch.column("row").field(text)
    for first, count in _runs(texts, limit):
        yield batch.slice(first, count), texts.slice(first, count).fill_null("")


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: int, count: int) -> np.ndarray:
    """The first powers of a base modulo 2^64, as products of those of a block and those of the blocks."""

    def running(factor: int, n: int) -> np.ndarray:
        steps = np.full(n, factor, dtype=np.uint64)
        steps[:1] = 1
        return np.cumprod(steps, dtype=np.uint64)

    block = 4096
    return np.multiply.outer(running(pow(base, block, 1 << 64), -(-count // block)), running(base, block)).reshape(-1)[:count]


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, from one running sum over the whole array."""
    running = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * _powers(_BASE, len(data)), dtype=np.uint64, out=running[1:])
    return mix64((running[ends] - running[starts]) * _powers(_BASE_INVERSE, len(data) + 1)[starts])


def word_spans(data: np.ndarray, edges: np.ndarray, is_word: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of each row, and the offsets of the rows among the words."""
    inside = is_word[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[edges] = True
    starts = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1])) | inside & first[:-1]) if len(data) else np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(inside & np.concatenate((~inside[1:], [True])) | inside & first[1:]) + 1 if len(data) else np.zeros(0, dtype=np.int64)
    return starts, ends, np.searchsorted(starts, edges)


def word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased (A-Z) words ``[0-9a-z]`` or beyond ASCII, and the offsets of the rows among them."""
    lowered = _LOWER[data]
    starts, ends, rows = word_spans(lowered, edges)
    return span_hashes(lowered, starts, ends), rows


MOST_BITS = 1 << 27
"""Bits of a broadcast bitmap at most (16 MB)."""


def bitmap(codes: DataFrame, count: int) -> np.ndarray:
    """The bits of all ``code`` values: 32 a value, but ``MOST_BITS`` at most, whatever the data. 64 places a row go to the driver."""
    bits = 1 << 16
    while bits < min(32 * count, MOST_BITS):
        bits *= 2
    place = F.expr(f"code & {bits - 1}L")
    rows = codes.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(code & 63 as int))")).alias("bits")).toArrow()
    found = np.zeros(bits // 64, np.uint64)
    found[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return found


def is_set(bitmap: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether the bits of the codes are set."""
    place = codes % np.uint64(len(bitmap) * 64)
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


MOST_GROUPS = 1000
"""Values that a sample is taken of at most, the commonest: labels and languages are far fewer, a dirty column may have more."""


def _shares(rows: DataFrame, group: str, per_group: int, count: Column) -> Column:
    """The share of the rows of each value of ``group`` that makes about ``per_group``; one row per value goes to the driver."""
    counts = rows.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("value")).agg(count.alias("n"))
    commonest = {r["value"]: r["n"] for r in counts.orderBy(F.desc("n"), "value").limit(MOST_GROUPS).collect()}
    if not commonest:
        return F.lit(0.0)
    known = F.create_map(*[x for value, n in sorted(commonest.items(), key=lambda kv: str(kv[0])) for x in (F.lit(value), F.lit(min(1.0, per_group / n)))])
    return F.coalesce(F.try_element_at(known, F.col(group).cast(rows.schema[group].dataType)), F.lit(0.0))


def _place(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in columns], F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))


def bounded_sample(rows: DataFrame, group: str, per_group: int, id_column: str) -> DataFrame:
    """About ``per_group`` rows of each value of ``group`` at most, chosen by a hash of the id.

    The share kept of a value is ``per_group`` over its count, so the sample does not follow the
    input. Of more than ``MOST_GROUPS`` values the commonest are sampled.
    """
    return rows.where(_place(id_column) < _shares(rows, group, per_group, F.count(F.lit(1))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, per_label: int, most_bytes: int) -> DataFrame:
    """``_id``, ``text`` and ``label`` of the bounded sample; only the sampled ids are broadcast.

    An id may be on many rows: of the rows whose id was chosen, equal ones count once, and a label with more than
    ``per_label`` of them is sampled again by id and text.
    """
    chosen = bounded_sample(labels.where(F.col(label).isin(0, 1)), label, per_label, doc_id)
    chosen = F.broadcast(chosen.select(F.col(doc_id).alias("_id"), F.col(label).alias("label")).distinct())
    wanted = docs.where(F.octet_length(F.coalesce(F.col(text), F.lit(""))) <= most_bytes).select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = wanted.join(chosen, "_id").withColumn("_text", F.xxhash64("text"))
    different = rows.select("_id", "_text", "label").distinct()
    kept = rows.where(_place("_id", "_text") < _shares(different, "label", per_label, F.count(F.lit(1))))
    return kept.dropDuplicates(["_id", "_text", "label"]).select("_id", "text", "label")
