"""SimHash near-duplicates with a covering family of bit masks.

A text's fingerprint has a bit set where over half of the hashes of its three-word shingles have
it. Fingerprints link if they differ in at most two bits; classes are connected components.

Candidates come from covering locality-sensitive hashing. Bit ``i`` has a code ``m(i)`` of three
bits, not zero, and there is a table for each of the seven vectors ``v`` other than zero: its mask
keeps the bits whose code has an odd number of ones in common with ``v``. The codes of two bits
span at most two of three dimensions, so some ``v`` is orthogonal to both, and its mask keeps
neither: every pair within the radius falls into one bucket of some table, with certainty.

Inside a bucket all members agree on the bits that the mask keeps. Two of them differ in at most
two bits if and only if there is a word ``z`` that each reaches by turning at most one of the other
bits. So each member is sent to its own word and to those one turned bit away, and a word keeps one
bit per turn: at most 28 members, in one number. No pairs are formed, no bucket is cut, and a
bucket of any size is spread over its words. The members of a word are linked to its smallest.

Buckets with one fingerprint are left out before; equal fingerprints are one node from the start.

Defined cases: a null text, or one without words, has fingerprint zero and is linked like others;
a text of one or two words has one shingle; repeated rows and ids are documents like others; a
component is named by its smallest id (null only if it has no other).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.session import settled

from .near_dup import contract
from .text import pieces, word_spans

SHINGLE_WORDS, SEED = 3, 42
RADIUS, BITS = 2, 64
_BLOCK = 1 << 17
"""Shingles whose bits are unpacked at a time."""

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Masks of kept bits, one per table: any ``radius`` bits are all left out by one of them."""
    vectors = range(1, 2 ** (radius + 1))
    code = [1 + i % len(vectors) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (code[i] & v).bit_count() % 2) for v in vectors]


def spaced_words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words with one space after each: the bytes, starts and ends of the words, offsets of the rows among them."""
    starts, ends, rows = word_spans(data, edges, _IS_WORD)
    length = ends - starts
    out = np.full(int((length + 1).sum()), 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(length + 1) - 1] = False
    out[inside] = _LOWER[data[_IS_WORD[data]]]
    to = np.cumsum(length + 1) - 1
    return out, to - length, to, rows


def fingerprints(data: np.ndarray, edges: np.ndarray, width: int = SHINGLE_WORDS) -> np.ndarray:
    """The fingerprint of each text, as unsigned 64-bit numbers."""
    spaced, starts, ends, rows = spaced_words(data, edges)
    words = np.diff(rows)
    shingles = np.where(words >= width, words - width + 1, (words > 0).astype(np.int64))
    offsets = np.concatenate(([0], np.cumsum(shingles)))
    counts = np.zeros((len(words), BITS), np.int64)
    text, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    for first in range(0, int(offsets[-1]), _BLOCK):
        which = np.arange(first, min(first + _BLOCK, int(offsets[-1])))
        owner = np.searchsorted(offsets, which, side="right") - 1
        begin = rows[owner] + which - offsets[owner]
        last = begin + np.minimum(words[owner], width) - 1
        hashes = np.fromiter((digest(text[a:b], SEED) for a, b in zip(starts[begin].tolist(), ends[last].tolist())), np.uint64, len(which))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        group = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        counts[owner[group]] += np.add.reduceat(bits, group, axis=0, dtype=np.int64)
    set_bits = (2 * counts > shingles[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").reshape(-1).view("<u8").astype(np.uint64)


def _fingerprinted(batches):
    for batch in batches:
        for piece, data, edges in pieces(batch, "text"):
            yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(fingerprints(data, edges).view(np.int64))], ["id", "fingerprint"])


def _signed(number: int) -> Column:
    return F.lit(number - (1 << 64) if number >> 63 else number).cast("bigint")


def _turns(mask: int) -> Column:
    """The bits that a mask leaves out, each as a number, and zero for no turn."""
    return F.array(F.lit(0).cast("bigint"), *[_signed(1 << i) for i in range(BITS) if not mask >> i & 1])


def linked_fingerprints(nodes: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between distinct ``fingerprint`` values two bits apart at most; all such pairs are connected by them."""
    masks = covering_masks()
    keys = F.array(*[F.struct(F.lit(t).alias("table"), (F.col("fingerprint").bitwiseAND(_signed(m))).alias("kept")) for t, m in enumerate(masks)])
    tables = nodes.select("fingerprint", F.inline(keys).alias("table", "kept"))
    shared = settled(tables.groupBy("table", "kept").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("table", "kept"))
    members = settled(tables.join(shared, ["table", "kept"]).select("table", "fingerprint"))
    turns = F.array(*[_turns(m) for m in masks])
    sent = members.select("table", "fingerprint", F.explode(F.get(turns, F.col("table"))).alias("turn"))
    words = sent.groupBy("table", F.col("fingerprint").bitwiseXOR(F.col("turn")).alias("word")).agg(
        F.bit_or("turn").alias("turned"), F.min(F.col("turn") != 0).alias("all_turned")
    )
    several = words.where((F.bit_count("turned") + F.when(F.col("all_turned"), 0).otherwise(1)) > 1)
    turned = F.filter(F.get(turns, F.col("table")), lambda t: (t != 0) & (t.bitwiseAND(F.col("turned")) != 0))
    found = F.transform(F.when(F.col("all_turned"), turned).otherwise(F.concat(F.array(F.lit(0).cast("bigint")), turned)), lambda t: t.bitwiseXOR(F.col("word")))
    return several.select(F.array_min(found).alias("a"), F.explode(found).alias("b")).where("a <> b").distinct()


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``fingerprint`` (a signed number) and ``component_id``, the smallest id of its component."""
    given = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    id_type = given.schema["id"].dataType.simpleString()
    marked = settled(given.mapInArrow(_fingerprinted, f"id {id_type}, fingerprint bigint"))
    nodes = settled(marked.groupBy("fingerprint").agg(F.min("id").alias("least")))
    node = F.xxhash64("fingerprint")  # one to one on 64-bit numbers; spreads neighbours
    links = linked_fingerprints(nodes).select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))
    named = nodes.select(node.alias("node"), node.alias("label"), "fingerprint", "least")
    labels = contract(named.select("node", "label"), links)
    known = settled(named.select("node", "fingerprint", "least").join(labels, "node"))
    smallest = known.groupBy("label").agg(F.min("least").alias("component_id"))
    component = settled(known.join(smallest, "label").select("fingerprint", "component_id"))
    return marked.join(component, "fingerprint").select(F.col("id").alias(doc_id), "fingerprint", "component_id")


def simhash_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The components with the fingerprint as 16 hexadecimal digits."""
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return simhash_components(docs, doc_id, text).withColumn("fingerprint", digits)
