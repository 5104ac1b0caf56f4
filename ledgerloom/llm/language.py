"""Language identification with hyperdimensional profiles.

Every symbol (a letter, or the gap between words) has a pseudo-random vector of +1 and -1.
The vector of a letter trigram binds (multiplies) its symbols' vectors, the first rolled
by two places and the second by one. A document bundles (sums) the vectors of all its
trigrams; a language's prototype bundles the unit vectors of its sample documents. The
prediction is the prototype with the highest cosine.

Prototypes are learned from a sample of about ``SAMPLE_PER_LANGUAGE`` whole documents a
language, chosen by a hash of the id; sums are made on the executors, one row per language
and dimension reaches the driver. Every document is then scored in one pass, unshuffled.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is every
text if nothing can be learned; ties go to the language that sorts first; a null id is
hashed as an empty text. Memory follows ``text.PIECE_BYTES`` or the longest single text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import as_rows, bounded_sample, mix64, pieces, remainder, row_pieces

DIMENSIONS = 512
SAMPLE_PER_LANGUAGE = 1_000
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
_BLOCK_TEXTS, _BLOCK_SYMBOLS, _BLOCK_GRAMS = 64, 200_000, 8_192

_letter_flags: np.ndarray | None = None


def is_letter() -> np.ndarray:
    """Which code points are letters; made once per process."""
    global _letter_flags
    if _letter_flags is None:
        _letter_flags = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letter_flags


def symbol_vectors(code_points: np.ndarray, dimensions: int) -> np.ndarray:
    """A row of +1 and -1 for each code point, the same in every process."""
    lanes = np.arange((dimensions + 63) // 64, dtype=np.uint64)
    seeds = mix64(code_points.astype(np.uint64) + np.uint64(1) << np.uint64(20))[:, None] + lanes[None, :]
    bits = np.unpackbits(mix64(seeds).view(np.uint8), axis=1)[:, :dimensions]
    return (bits.astype(np.int8) << 1) - 1


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters with one gap (a space) before, between and after words, flat, and the offsets of the texts."""
    lowered = [" " + t.lower() + " " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = is_letter()[points]
    starts = np.cumsum([0, *map(len, lowered)])
    first = np.zeros(len(points), bool)
    first[starts[:-1]] = True
    keep = letter | first
    keep[1:] |= letter[:-1]
    flat = np.where(letter, points, 32)[keep]
    return flat, np.concatenate(([0], np.cumsum(keep)))[starts]


def bundle(texts: list[str], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The summed trigram vectors of each text, and whether it has a letter."""
    flat, edges = symbols(texts)
    sums = np.zeros((len(texts), dimensions), np.float32)
    sizes = np.diff(edges)
    low = 0
    while low < len(texts):
        high = low + 1
        while high < len(texts) and high - low < _BLOCK_TEXTS and edges[high + 1] - edges[low] <= _BLOCK_SYMBOLS:
            high += 1
        sums[low:high] = _bundle_block(flat[edges[low] : edges[high]], edges[low : high + 1] - edges[low], dimensions)
        low = high
    return sums, sizes > 1


def _bundle_block(flat: np.ndarray, edges: np.ndarray, dimensions: int) -> np.ndarray:
    rows = len(edges) - 1
    out = np.zeros((rows, dimensions), np.float32)
    if len(flat) < 3:
        return out
    present = np.flatnonzero(np.bincount(flat))
    number = np.zeros(int(present[-1]) + 1, np.int64)
    number[present] = np.arange(len(present))
    coded, size = number[flat], len(present)
    owner = np.repeat(np.arange(rows), np.diff(edges))
    whole = owner[:-2] == owner[2:]
    grams = ((coded[:-2] * size + coded[1:-1]) * size + coded[2:])[whole]
    found, place = np.unique(grams, return_inverse=True)
    owner = owner[:-2][whole]
    vectors = symbol_vectors(present, dimensions)
    once, twice = np.roll(vectors, 1, axis=1), np.roll(vectors, 2, axis=1)
    for low in range(0, len(found), _BLOCK_GRAMS):
        some = found[low : low + _BLOCK_GRAMS]
        here = (place >= low) & (place < low + len(some))
        counts = np.bincount(owner[here] * len(some) + place[here] - low, minlength=rows * len(some)).reshape(rows, len(some))
        bound = twice[some // (size * size)] * once[some // size % size] * vectors[some % size]
        out += counts.astype(np.float32) @ bound.astype(np.float32)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def learn_prototypes(
    labelled: DataFrame, text: str = "text", language: str = "lang", doc_id: str = "doc_id",
    per_language: int = SAMPLE_PER_LANGUAGE, dimensions: int = DIMENSIONS,
) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and their unit prototypes, from a bounded sample of the rows."""
    known = labelled.where(F.col(language).isNotNull() & F.col(text).isNotNull())
    sample = bounded_sample(known, language, per_language, doc_id).select(F.col(language).alias("language"), F.col(text).alias("text"))

    def partial(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece, _, _ in pieces(batch, "text"):
                vectors = _unit(bundle(piece.column("text").to_pylist(), dimensions)[0])
                names = np.array(piece.column("language").to_pylist(), dtype=object)
                for name in set(names):
                    sums[name] = sums.get(name, 0) + vectors[names == name].sum(axis=0, dtype=np.float64)
        for name, vector in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * dimensions), pa.array(range(dimensions), pa.int32()), pa.array(vector, pa.float64())], ["language", "dimension", "total"])

    totals = sample.mapInArrow(partial, "language string, dimension int, total double").groupBy("language", "dimension").agg(F.sum("total").alias("total"))
    rows = totals.collect()
    names = sorted({r.language for r in rows})
    table = np.zeros((len(names), dimensions))
    for r in rows:
        table[names.index(r.language), r.dimension] = r.total
    return names, _unit(table).astype(np.float32)


def predict_language(docs: DataFrame, names: list[str], prototypes: np.ndarray, text: str = "text") -> DataFrame:
    """``row`` (the document as it came), ``lang_pred``, ``score`` (the cosine, not below 0)."""
    rows = as_rows(docs)
    schema = rows.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    labels = np.array([*names, UNKNOWN], dtype=object)

    def predict(batches):
        for batch in batches:
            for piece, texts in row_pieces(batch, text):
                sums, any_letter = bundle(texts.to_pylist(), prototypes.shape[1])
                best, score = np.full(piece.num_rows, len(names)), np.zeros(piece.num_rows)
                if names:
                    cosine = _unit(sums) @ prototypes.T
                    best = np.where(any_letter, cosine.argmax(axis=1), len(names))
                    score = np.where(any_letter, np.clip(cosine.max(axis=1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row"), pa.array(labels[best].tolist(), pa.string()), pa.array(score.astype(np.float64))], ["row", "lang_pred", "score"]
                )

    return rows.mapInArrow(predict, schema)


def language_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", language: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, then predict every row."""
    training = docs.where(remainder(doc_id, FOLDS) != HELD_OUT)
    names, prototypes = learn_prototypes(training, text, language, doc_id)
    predicted = predict_language(docs.select(doc_id, text), names, prototypes, text)
    return predicted.select(F.col(f"row.{doc_id}").alias(doc_id), "lang_pred", "score").select(
        doc_id, (remainder(doc_id, FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score"
    )
