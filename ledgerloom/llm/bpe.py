"""Byte-level BPE: encoding by batched merge rounds over flat numpy arrays, and decoding.

Texts are split into words; each distinct word is encoded once per worker. The symbols of
all new words lie in one flat array. A round looks up the rank of every neighbouring pair
(binary search over sorted pair keys), takes each word's lowest rank, and merges all its
places from left to right; words without a mergeable pair leave the rounds.

The vocabulary file is read on the driver and broadcast; its size is fixed by the file.
Nothing is shuffled. Defined cases: a null text is an empty one and has no tokens; strings
of special tokens inside a text become those tokens; repeated rows are encoded each; other
columns pass through. Memory of a task: ``text.PIECE_BYTES`` of text or the longest text,
and remembered words of ``MEMO_BYTES``, which only save work.
"""

from __future__ import annotations

import json
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .text import as_rows, row_pieces

#: Fixed value: how byte-level vocabularies of this kind split a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO_BYTES = 1_500_000
"""Words are remembered until they have so many bytes; each costs about a hundred more."""


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: visible Latin-1 itself, the rest from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Arrays of a byte-level BPE file: pair keys and ranks, merged symbols, the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        if content["model"]["type"] != "BPE" or content["normalizer"] or content["pre_tokenizer"] != {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": content["pre_tokenizer"].get("trim_offsets"), "use_regex": True,
        }:
            raise ValueError("a byte-level BPE file without normaliser or added space is needed")
        vocab = content["model"]["vocab"]
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        if any(t[flag] for t in content["added_tokens"] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("special tokens that take in their surroundings are not supported")
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        spelled = [b""] * self.size
        for token, number in vocab.items():
            spelled[number] = bytes(byte_of[c] for c in token)
        for token, number in self.special.items():
            spelled[number] = token.encode()
        self.spelling = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelling_edges = np.cumsum([0, *map(len, spelled)])
        self.of_byte = np.array([vocab[letter] for letter in letters], np.int32)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in content["model"]["merges"]]
        first = np.array([vocab[a] for a, _ in merges], np.int64)
        second = np.array([vocab[b] for _, b in merges], np.int64)
        keys = first * self.size + second
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or the number of merges for a pair that has none."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], len(self.merged)).astype(np.int32)


def merge_rounds(vocabulary: Vocabulary, symbols: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words given as flat byte symbols: flat ids and the number of ids of each word."""
    none = len(vocabulary.merged)
    words = len(edges) - 1
    owner = np.repeat(np.arange(words), np.diff(edges))
    done_ids, done_owner = [], []
    while len(symbols):
        rank = np.full(len(symbols), none, np.int32)
        same = owner[:-1] == owner[1:]
        rank[:-1][same] = vocabulary.ranks(symbols[:-1][same], symbols[1:][same])
        first = np.flatnonzero(np.concatenate(([True], ~same)))
        lowest = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(symbols))))
        finished = lowest == none
        if finished.any():
            done_ids.append(symbols[finished])
            done_owner.append(owner[finished])
            symbols, owner, rank, lowest = (x[~finished] for x in (symbols, owner, rank, lowest))
            if not len(symbols):
                break
        here = rank == lowest
        # In a run of equal symbols every other place merges, counted from its left end.
        at = np.flatnonzero(here)
        run_start = np.concatenate(([True], (np.diff(at) > 1) | (owner[at][1:] != owner[at][:-1])))
        within = np.arange(len(at)) - np.maximum.accumulate(np.where(run_start, np.arange(len(at)), 0))
        at = at[within % 2 == 0]
        symbols[at] = vocabulary.merged[rank[at]]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    if not done_ids:
        return np.zeros(0, np.int32), np.zeros(words, np.int64)
    ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
    return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=words)


class _Numbers(dict):
    """Numbers words in the order they are first met."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Encoder:
    """Encodes texts with a memory of words; results do not depend on what it remembers."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.split = regex.compile(SPLIT).findall
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.forget()

    def forget(self) -> None:
        self.numbers, self.bytes = _Numbers(), 0
        self.ids = np.zeros(0, np.int32)
        self.counts = np.zeros(0, np.int64)
        for token, number in self.vocabulary.special.items():
            self.numbers[token] = len(self.counts)
            self.ids = np.append(self.ids, np.int32(number))
            self.counts = np.append(self.counts, 1)

    def words(self, text: str) -> list[str]:
        if self.special and self.special.search(text):
            return [w for i, part in enumerate(self.special.split(text)) for w in ([part] if i % 2 else self.split(part))]
        return self.split(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the offsets of the texts among them."""
        if self.bytes > MEMO_BYTES:
            self.forget()
        known = len(self.counts)
        numbered = [np.fromiter(map(self.numbers.__getitem__, self.words(text)), np.int32) for text in texts]
        if len(self.numbers) > known:
            spelled = [w.encode() for w in islice(self.numbers, known, None)]
            self.bytes += sum(map(len, spelled))
            symbols = self.vocabulary.of_byte[np.frombuffer(b"".join(spelled), np.uint8)]
            ids, counts = merge_rounds(self.vocabulary, symbols, np.cumsum([0, *map(len, spelled)]))
            self.ids, self.counts = np.concatenate((self.ids, ids)), np.concatenate((self.counts, counts))
        starts = np.cumsum(self.counts) - self.counts
        flat = np.concatenate(numbered) if numbered else np.zeros(0, np.int32)
        ids = self.ids[_ranges(starts[flat], self.counts[flat])]
        sizes = np.concatenate(([0], np.cumsum(self.counts[flat])))
        return ids, sizes[np.cumsum([0, *map(len, numbered)])]


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``counts`` of them, one run after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def decode(vocabulary: Vocabulary, ids: np.ndarray, edges: np.ndarray) -> list[str]:
    """The texts that runs of ids spell; bytes that are no UTF-8 become U+FFFD."""
    sizes = np.diff(vocabulary.spelling_edges)[ids]
    data = vocabulary.spelling[_ranges(vocabulary.spelling_edges[ids], sizes)].tobytes()
    ends = np.concatenate(([0], np.cumsum(sizes)))[edges].tolist()
    return [data[low:high].decode("utf-8", "replace") for low, high in zip(ends, ends[1:])]


def bpe_round_trip(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``row`` (the document as it came), ``n_tokens``, ``ids`` (little-endian unsigned 32-bit), ``decoded``."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path or default_vocabulary()))
    rows = as_rows(docs)
    schema = rows.select("row", F.lit(0).cast("bigint").alias("n_tokens"), F.lit(b"").alias("ids"), F.lit("").alias("decoded")).schema

    def encode(batches):
        vocabulary = shared.value
        encoder = Encoder(vocabulary)
        for batch in batches:
            for piece, texts in row_pieces(batch, text):
                ids, edges = encoder.encode(texts.to_pylist())
                raw = pa.py_buffer(ids.astype("<u4").tobytes())
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), piece.num_rows, [None, pa.py_buffer((edges * 4).astype(np.int64).tobytes()), raw])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row"), pa.array(np.diff(edges), pa.int64()), packed.cast(pa.binary()), pa.array(decode(vocabulary, ids, edges), pa.string())],
                    ["row", "n_tokens", "ids", "decoded"],
                )

    return rows.mapInArrow(encode, schema)


def bpe_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """The digest per document: tokens, digest of the ids, digest of the decoded text."""
    return bpe_round_trip(docs.select(doc_id, text), text, path).select(
        F.col(f"row.{doc_id}").alias(doc_id), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
