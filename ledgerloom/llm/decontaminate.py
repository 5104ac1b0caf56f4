"""Benchmark decontamination with suffix arrays over the training texts.

The words of a run of documents form one shard. Its suffixes are sorted (prefix doubling)
into a suffix array, in which every window of the benchmark is found by binary search: the
range of equal suffixes lists all places of the window. Words that no benchmark text has
cannot start or continue a match, so suffixes that begin with one are left out. Windows that
follow one another in a document and in an item are drawn together to longest matches with
their places in both (``benchmark_matches``); a document's share of words inside any of them
decides whether it is contaminated.

Documents are read once per block of the benchmark and are never shuffled. A block of the
benchmark (``block_bytes`` of text) is broadcast; a larger benchmark takes several passes.

Defined cases: a null or empty text has no words and is clean; a benchmark text without
words has no windows; items that share an id count once; repeated documents are judged
each for itself; other columns pass through whatever they are called. Memory of a task
follows ``SHARD_BYTES`` or the longest single text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerloom.session import settled

from .text import as_rows, flat_bytes, pieces, row_pieces, word_hashes

WINDOW = 13
SHARE = 20
"""A document is contaminated if at least one in ``SHARE`` of its words is hit."""
BLOCK_BYTES = 32_000_000
SHARD_BYTES = 2_000_000
"""Texts of one suffix array, in which every window of the benchmark is searched."""

_STATE = "n_words bigint, hits binary, items array<string>"


class TestWindows:
    """The distinct windows of one block of benchmark texts, as rows of word numbers."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        texts = pa.array([text for _, text in items], pa.string())
        batch = pa.record_batch([texts], ["text"])
        found: dict[bytes, list[tuple[int, int]]] = {}
        hashes, rows = [], [0]
        for _, data, edges in pieces(batch, "text"):
            some, places = word_hashes(data, edges)
            rows += (places[1:] + rows[-1]).tolist()
            hashes.append(some)
        words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.vocabulary = np.unique(words)
        numbers = (np.searchsorted(self.vocabulary, words) + 1).astype(np.int32)
        for nth, (low, high) in enumerate(zip(rows[:-1], rows[1:])):
            size = min(width, high - low)
            for start in range(low, high - size + 1) if size else ():
                found.setdefault(numbers[start : start + size].tobytes(), []).append((nth, start - low))
        keys = sorted(found)
        self.width, self.names = width, [item for item, _ in items]
        self.places = [np.array(found[key], np.int64) for key in keys]
        self.items = [sorted({self.names[nth] for nth, _ in found[key]}) for key in keys]
        self.lengths = np.array([len(key) // 4 for key in keys], dtype=np.int64)
        self.windows = np.zeros((len(keys), width), dtype=np.int32)
        for at, key in enumerate(keys):
            self.windows[at, : len(key) // 4] = np.frombuffer(key, np.int32)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The benchmark's number of each word, 0 for a word it does not have."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int32)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.int32)


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions of non-zero words, sorted by the ``depth`` words from there on; 0 ends a suffix."""
    places = np.flatnonzero(words)
    rank = words.astype(np.int64)
    reach = 1
    while reach < depth and len(places):
        follow = np.zeros(len(words), np.int64)
        follow[: len(words) - reach] = rank[reach:]
        key = rank[places] * (int(rank.max()) + 1) + follow[places]
        _, order = np.unique(key, return_inverse=True)
        rank = np.zeros(len(words), np.int64)
        rank[places] = order + 1
        reach *= 2
    return places[np.argsort(rank[places], kind="stable")]


def _bound(words: np.ndarray, suffixes: np.ndarray, tests: TestWindows, after: bool) -> np.ndarray:
    """For each window the first suffix that is not below it, or with ``after`` the first above it."""
    low = np.zeros(len(tests.lengths), np.int64)
    high = np.full(len(tests.lengths), len(suffixes), np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        start = suffixes[middle]
        sign = np.zeros(len(open_), np.int8)
        alive = np.arange(len(open_))
        for step in range(tests.windows.shape[1]):
            alive = alive[tests.lengths[open_[alive]] > step]
            if not alive.size:
                break
            theirs, ours = words[start[alive] + step], tests.windows[open_[alive], step]
            sign[alive] = np.sign(theirs.astype(np.int64) - ours)
            alive = alive[sign[alive] == 0]
        below = sign <= 0 if after else sign < 0
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
    return low


def occurrences(words: np.ndarray, tests: TestWindows) -> tuple[np.ndarray, np.ndarray]:
    """Every place of every window in ``words``: positions and window numbers."""
    width = tests.windows.shape[1]
    padded = np.concatenate((words, np.zeros(width, np.int32)))
    suffixes = suffix_array(padded, width)
    first, beyond = _bound(padded, suffixes, tests, False), _bound(padded, suffixes, tests, True)
    counts = beyond - first
    which = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return suffixes[first[which] + inner], which


def _search(piece: pa.RecordBatch, data: np.ndarray, edges: np.ndarray, tests: TestWindows):
    """Per row of the piece: number of words, a flag for each word that is hit, items found."""
    hashes, rows = word_hashes(data, edges)
    numbers = tests.numbers(hashes)
    # A zero after each document keeps suffixes from running into the next one.
    shifted = np.zeros(len(numbers) + piece.num_rows, np.int32)
    owner = np.repeat(np.arange(piece.num_rows), np.diff(rows))
    shifted[np.arange(len(numbers)) + owner] = numbers
    places, which = occurrences(shifted, tests)
    starts = rows + np.arange(piece.num_rows + 1)
    ramp = np.zeros(len(shifted) + 1, np.int64)
    np.add.at(ramp, places, 1)
    np.add.at(ramp, places + tests.lengths[which], -1)
    hit = np.cumsum(ramp[:-1]) > 0
    document = np.searchsorted(starts, places, side="right") - 1
    pairs = np.unique(document * max(1, len(tests.lengths)) + which)
    items: dict[int, set[str]] = {}
    for pair in pairs.tolist():
        items.setdefault(pair // len(tests.lengths), set()).update(tests.items[pair % len(tests.lengths)])
    flags = [hit[starts[i] : starts[i + 1] - 1] for i in range(piece.num_rows)]
    return np.diff(rows), flags, [items.get(i, set()) for i in range(piece.num_rows)]


def longest_matches(data: np.ndarray, edges: np.ndarray, tests: TestWindows) -> list[tuple[int, int, int, int, int]]:
    """All verbatim matches that cannot be made longer: row, first word, item (its number), its first word, words.

    Windows that follow one another in a document and in an item lie on one diagonal; each unbroken run of
    them is one match. Matches have ``width`` words at least, or are whole items of fewer.
    """
    hashes, rows = word_hashes(data, edges)
    count = len(edges) - 1
    owner = np.repeat(np.arange(count), np.diff(rows))
    shifted = np.zeros(len(hashes) + count, np.int32)
    shifted[np.arange(len(hashes)) + owner] = tests.numbers(hashes)
    places, which = occurrences(shifted, tests)
    if not len(places):
        return []
    times = np.array([len(tests.places[w]) for w in which])
    at, window = np.repeat(places, times), np.repeat(which, times)
    item, start = np.concatenate([tests.places[w] for w in which]).T
    starts = rows + np.arange(count + 1)
    row = np.searchsorted(starts, at, side="right") - 1
    word = at - starts[row]
    order = np.lexsort((word, word - start, item, row))
    row, word, item, start, size = row[order], word[order], item[order], start[order], tests.lengths[window[order]]
    goes_on = np.zeros(len(row), bool)
    goes_on[1:] = (row[1:] == row[:-1]) & (item[1:] == item[:-1]) & (word[1:] == word[:-1] + 1) & (start[1:] == start[:-1] + 1)
    first = np.flatnonzero(~goes_on)
    last = np.append(first[1:], len(row)) - 1
    return list(zip(row[first].tolist(), word[first].tolist(), item[first].tolist(), start[first].tolist(), (word[last] + size[last] - word[first]).tolist()))


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every longest verbatim match: ``row`` (the document without its text), ``word``, ``item``, ``item_word``, ``words`` (places from 0).

    One pass per block of the benchmark. An item that stands in the benchmark twice is matched twice.
    """
    spark, kept = docs.sparkSession, [c for c in docs.columns if c != text]
    rows = as_rows(docs)
    head = rows.select(F.struct(*[F.col(f"row.`{c}`").alias(c) for c in kept]).alias("row"))
    schema = StructType([*head.schema.fields, *[StructField(c, t) for c, t in (("word", LongType()), ("item", StringType()), ("item_word", LongType()), ("words", LongType()))]])
    found = None
    for block in _blocks(benchmark, item_id, item_text, block_bytes):
        shared = spark.sparkContext.broadcast(TestWindows(block, window))

        def search(batches, shared=shared):
            tests = shared.value
            for batch in batches:
                for piece, texts in row_pieces(batch, text, SHARD_BYTES):
                    matches = longest_matches(*flat_bytes(texts), tests)
                    if not matches:
                        continue
                    row, word, item, item_word, words = zip(*matches)
                    struct = piece.column("row").take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.StructArray.from_arrays([struct.field(c) for c in kept], names=kept), pa.array(word, pa.int64()),
                         pa.array([tests.names[i] for i in item], pa.string()), pa.array(item_word, pa.int64()), pa.array(words, pa.int64())],
                        ["row", "word", "item", "item_word", "words"],
                    )

        matched = settled(rows.mapInArrow(search, schema))
        found = matched if found is None else found.union(matched)
    return spark.createDataFrame([], schema) if found is None else found


def _blocks(benchmark: DataFrame, id_column: str, text_column: str, block_bytes: int):
    """The benchmark in blocks; the driver holds one at a time."""
    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(id_column).cast("string"), F.lit("null")), F.coalesce(F.col(text_column), F.lit("")))
    for item, text in rows.toLocalIterator():
        block.append((item, text))
        size += len(text)
        if size >= block_bytes:
            yield block
            block, size = [], 0
    yield block


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``row`` (the document as it came), ``n_words``, ``hits`` (a bit per word, high bit first), ``items`` (ids found, sorted)."""
    spark = docs.sparkSession
    state, first = as_rows(docs).select(
        "row", F.lit(0).cast("bigint").alias("n_words"), F.lit(b"").alias("hits"), F.array().cast("array<string>").alias("items"),
    ), True
    for block in _blocks(benchmark, item_id, item_text, block_bytes):
        state, first = state if first else settled(state), False  # one block of the benchmark in memory at a time
        shared = spark.sparkContext.broadcast(TestWindows(block, window))

        def search(batches, shared=shared):
            tests = shared.value
            for batch in batches:
                for piece, texts in row_pieces(batch, text, SHARD_BYTES):
                    counts, flags, items = _search(piece, *flat_bytes(texts), tests)
                    earlier = piece.column("hits").to_pylist(), piece.column("items").to_pylist()
                    for i, (bits, names) in enumerate(zip(*earlier)):
                        if bits:
                            flags[i] = flags[i] | np.unpackbits(np.frombuffer(bits, np.uint8), count=len(flags[i])).astype(bool)
                        items[i] = items[i].union(names)
                    yield pa.RecordBatch.from_arrays(
                        [
                            piece.column("row"), pa.array(counts, pa.int64()),
                            pa.array([np.packbits(f).tobytes() if f.any() else b"" for f in flags], pa.binary()),
                            pa.array([sorted(names) for names in items], pa.list_(pa.string())),
                        ],
                        ["row", "n_words", "hits", "items"],
                    )

        state = state.mapInArrow(search, state.schema)
    return state


def _count_bits(hits: str) -> F.Column:
    """The number of set bits of a binary column."""
    hexed = F.hex(hits)
    total = F.lit(0)
    for ones, digits in ((1, "1248"), (2, "3569AC"), (3, "7BDE"), (4, "F")):
        total = total + ones * (F.length(hexed) - F.length(F.translate(hexed, digits, "")))
    return total.cast("bigint")


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: ``row``, ``n_words``, ``n_hit``, ``items``, ``contaminated``."""
    found = benchmark_hits(docs, benchmark, **options)
    n_hit = _count_bits("hits")
    return found.select(
        "row", "n_words", n_hit.alias("n_hit"), "items",
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated documents, with the columns they came with."""
    return contamination(docs, benchmark, **options).where(~F.col("contaminated")).select("row.*")


def decontamination_report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The digest per document: words, words hit, items found and the digest of their ids."""
    judged = contamination(docs.select(doc_id, text), benchmark, text=text)
    items = F.col("items")
    return judged.select(
        F.col(f"row.{doc_id}").alias(doc_id), "n_words", "n_hit", F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )
