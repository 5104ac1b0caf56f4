"""Near-duplicate documents with DartMinHash signatures and banded joining.

Elements are shingles of five words, weighted by how often a text has them; texts of fewer
words have one shingle. Darts are thrown by hash into cells of one unit of weight by one
unit of rank: a cell has a Poisson number of them, each with a coordinate and a rank. A text
takes the darts within its weights up to a rank that makes about ``k (ln k + 3)`` of them,
and keeps the earliest of each coordinate; a text that misses a coordinate goes further.
Two texts agree on a coordinate with the probability of their weighted Jaccard similarity.

Texts with equal elements form one node. Nodes that agree on a whole band share a bucket.
Links are verified on the elements themselves:

1. each node with one leader (the smallest of its buckets' smallest nodes), which settles
   most of a large group of near copies with one pair a node;
2. inside buckets that still hold several classes, one node of each class with one of the
   largest class, as long as that finds links;
3. then, in buckets of up to ``FEW_NODES``, the nodes of different classes by a byte of each
   coordinate; only pairs that agree on ``CLOSE`` of them (a pair of similarity 0.8 is six deviations
   above that) have their elements compared;
4. in larger buckets, all nodes outside the largest class with all nodes of other classes, in blocks:
   both sides of a bucket are dealt into blocks of about ``BLOCK_BYTES`` of elements, and each block
   of the one meets each block of the other as one row, of which only links come out.

No pair row inside a large bucket is formed, no bucket is cut, and no group meets in
one task: buckets are aggregated before they are joined, the joins have no other work in their
stage, so Spark can split them. Classes are the connected components of the verified links, found
by contraction. Steps used again are written to the shared folder ``spark.checkpoint.dir``.

Defined cases: a null text or one without words is a class of its own; a class is named by
its smallest id; repeated rows are documents like others; node ids are 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.session import settled

from .text import as_rows, bitmap, is_set, mix64, pieces, word_hashes

SHINGLE_WORDS, SIMILARITY = 5, 0.8
BANDS, BAND_ROWS = 36, 8
FEW_NODES, CLOSE = 32, 0.65
"""A bucket of so many nodes is small; the share of coordinates on which a pair must agree there to be compared by its elements."""
BLOCK_BYTES = 1_000_000
"""Elements of a bucket's nodes that are compared at a time with as many others."""
SENT_PAIRS = 1_000_000
"""Pairs that are broadcast at most (16 MB)."""
BITMAP_BITS = 1 << 24
"""Size of the broadcast bitmap of wanted nodes; a full one only lets more rows through."""

_EMPTY = np.iinfo(np.uint64).max
_RANK_BITS = 44
_BLOCK_CELLS = 300_000
#: Chances that a cell has at most so many darts (Poisson with mean 1), as 64-bit integers.
_DARTS = (np.cumsum([np.exp(-1) / np.prod(np.arange(1, n + 1), dtype=float) for n in range(18)]) * 2.0**53).astype(np.uint64)


def shingle_elements(data: np.ndarray, edges: np.ndarray, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's shingles, and the offsets of the texts. The second time a shingle occurs it is another element."""
    words, rows = word_hashes(data, edges)
    counts = np.diff(rows)
    shingles = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(counts)), shingles)
    offsets = np.concatenate(([0], np.cumsum(shingles)))
    start = rows[:-1][owner] + np.arange(offsets[-1]) - offsets[:-1][owner]
    length = np.minimum(counts, width)[owner]
    hashes = np.zeros(offsets[-1], np.uint64)
    for step in range(width):
        more = length > step
        hashes[more] = mix64(hashes[more] * np.uint64(3) + words[start[more] + step] + np.uint64(1))
    order = np.lexsort((hashes, owner))
    hashes = hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    place = np.arange(len(hashes))
    again = place - np.maximum.accumulate(np.where(fresh, place, 0))
    return np.where(again > 0, mix64(hashes + again.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), hashes), offsets


def node_ids(elements: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of each text's elements, whatever their order."""
    running = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(elements + np.uint64(77)), dtype=np.uint64)))
    return mix64((running[offsets[1:]] - running[offsets[:-1]]) + np.diff(offsets).astype(np.uint64)).view(np.int64)


def dart_minhash(elements: np.ndarray, offsets: np.ndarray, k: int = BANDS * BAND_ROWS, weights: np.ndarray | None = None) -> np.ndarray:
    """Signatures of ``k`` ranks for weighted sets given as flat elements; weights of up to 1 each (default 1).

    A larger weight is given as several elements, as ``shingle_elements`` does. Sets must not be empty.
    """
    out = np.empty((len(offsets) - 1, k), np.uint64)
    if weights is None:
        totals = np.diff(offsets).astype(float)
    else:
        totals = np.add.reduceat(weights, offsets[:-1])
    reach = k * (np.log(k) + 3) / totals
    todo = np.arange(len(totals))
    while todo.size:
        cells = np.diff(offsets)[todo] * np.ceil(reach[todo]).astype(np.int64)
        block = np.cumsum(cells) // _BLOCK_CELLS
        missing = []
        for some in np.split(todo, np.flatnonzero(np.diff(block)) + 1):
            out[some] = _throw(elements, offsets, weights, some, reach[some], k)
            missing.append(some[(out[some] == _EMPTY).any(axis=1)])
        todo = np.concatenate(missing)
        reach[todo] *= 2
    return out


def _throw(elements: np.ndarray, offsets: np.ndarray, weights: np.ndarray | None, sets: np.ndarray, reach: np.ndarray, k: int) -> np.ndarray:
    """The earliest rank of each coordinate among the darts of each set up to its reach."""
    sizes = np.diff(offsets)[sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    at = np.arange(len(owner)) + np.repeat(offsets[sets] - (np.cumsum(sizes) - sizes), sizes)
    deep = np.ceil(reach).astype(np.int64)[owner]
    row = np.repeat(np.arange(len(owner)), deep)
    rank_cell = (np.arange(len(row)) - np.repeat(np.cumsum(deep) - deep, deep)).astype(np.uint64)
    cell = mix64(elements[at][row] + rank_cell * np.uint64(0xD1342543DE82EF95))
    darts = np.searchsorted(_DARTS, mix64(cell + np.uint64(11)) >> np.uint64(11), side="right")
    which = np.repeat(np.arange(len(row)), darts)
    nth = (np.arange(len(which)) - np.repeat(np.cumsum(darts) - darts, darts)).astype(np.uint64)
    dart = mix64(cell[which] + (nth + np.uint64(1)) * np.uint64(0x2545F4914F6CDD1D))
    rank = (rank_cell[which] << np.uint64(_RANK_BITS)) | (dart >> np.uint64(64 - _RANK_BITS))
    mine = row[which]
    inside = rank < (reach * 2.0**_RANK_BITS).astype(np.uint64)[owner[mine]]
    other = mix64(dart + np.uint64(5))
    if weights is not None:
        inside &= (other >> np.uint64(32)) < (weights[at][mine] * 2.0**32).astype(np.uint64)
    coordinate = (other & np.uint64(0xFFFFFFFF)) % np.uint64(k)
    best = np.full(len(sets) * k, _EMPTY, np.uint64)
    np.minimum.at(best, owner[mine[inside]] * k + coordinate[inside].astype(np.int64), rank[inside])
    return best.reshape(len(sets), k)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash of each band of each signature, with the band's number in it."""
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), bands)).copy()
    parts = signatures.reshape(len(signatures), bands, rows)
    for row in range(rows):
        keys = mix64(keys * np.uint64(3) + parts[:, :, row])
    return keys.view(np.int64)


def _sketch(batches):
    """Rows in, rows with node, size and band keys out; nulls for texts without words."""
    for batch in batches:
        for piece, data, edges in pieces(batch, "text"):
            elements, offsets = shingle_elements(data, edges)
            sizes = np.diff(offsets)
            nodes = node_ids(elements, offsets)
            full = np.flatnonzero(sizes)
            some, first, back = np.unique(nodes[full], return_index=True, return_inverse=True)
            pick = full[first]
            keys = np.zeros((0, BANDS), np.int64)
            if len(pick):
                chosen = np.concatenate([elements[offsets[i] : offsets[i + 1]] for i in pick])
                signatures = dart_minhash(chosen, np.concatenate(([0], np.cumsum(sizes[pick]))))
                keys = band_keys(signatures, BANDS, BAND_ROWS)
            bands: list = [None] * piece.num_rows
            for i, b in zip(full.tolist(), back.tolist()):
                bands[i] = keys[b]
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("text_hash"), pa.array(nodes, pa.int64(), mask=sizes == 0), pa.array(bands, pa.list_(pa.int64()))],
                ["id", "text_hash", "node", "bands"],
            )


def _node_elements(wanted: np.ndarray):
    """Rows in, node, elements and short signature (a byte of each coordinate) of the rows whose node may be wanted out."""

    def emit(batches):
        for batch in batches:
            for piece, data, edges in pieces(batch, "text"):
                elements, offsets = shingle_elements(data, edges)
                nodes = node_ids(elements, offsets)
                place = nodes.view(np.uint64) % np.uint64(BITMAP_BITS)
                hit = (wanted[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)
                keep = np.flatnonzero((hit > 0) & (np.diff(offsets) > 0))
                keep = keep[np.unique(nodes[keep], return_index=True)[1]]
                sets = [elements[offsets[i] : offsets[i + 1]] for i in keep]
                short = np.zeros((0, BANDS * BAND_ROWS), np.uint8)
                if sets:
                    signatures = dart_minhash(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
                    short = (mix64(signatures) & np.uint64(0xFF)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[keep], pa.int64()), pa.array([np.sort(x).tobytes() for x in sets], pa.binary()), pa.array([x.tobytes() for x in short], pa.binary())],
                    ["node", "elements", "short"],
                )

    return emit


def _wanted_bitmap(nodes: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with the places of the nodes; one row per 64 places goes to the driver."""
    place = F.pmod(F.col("node"), F.lit(BITMAP_BITS))
    words = nodes.groupBy(F.shiftright(place, 6).alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, cast(pmod(node, {BITMAP_BITS}) & 63 as int)))").alias("bits"))
    bitmap = np.zeros(BITMAP_BITS // 64, np.uint64)
    for word, bits in words.collect():
        bitmap[word] = np.int64(bits).view(np.uint64)
    return bitmap


def similar(left: bytes, right: bytes, threshold: float) -> bool:
    """Whether two sorted element sets have that Jaccard similarity."""
    a, b = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
    if min(len(a), len(b)) < threshold * max(len(a), len(b)) - 1e-9:
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common + 1e-9 >= threshold * (len(both) - common)


def _verified(pairs: DataFrame, elements: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a``, ``b`` of nodes that are similar enough. ``pairs`` are written already.

    Up to ``SENT_PAIRS`` of them are sent to the elements, which then stay where they are but for
    those that are wanted; more are joined with them by shuffling both.
    """
    left = elements.select(F.col("node").alias("a"), F.col("elements").alias("left"))
    right = elements.select(F.col("node").alias("b"), F.col("elements").alias("right"))
    if pairs.count() <= SENT_PAIRS:
        right, pairs = right.join(F.broadcast(pairs.select("b").distinct()), "b", "left_semi"), F.broadcast(pairs)

    def check(batches):
        for batch in batches:
            keep = [similar(x.as_py(), y.as_py(), threshold) for x, y in zip(batch.column("left"), batch.column("right"))]
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    size = F.octet_length
    possible = F.least(size("left"), size("right")) >= (threshold - 1e-9) * F.greatest(size("left"), size("right"))
    return settled(left.join(pairs, "a").join(right, "b").where(possible).select("a", "b", "left", "right").mapInArrow(check, "a bigint, b bigint"))


def contract(labels: DataFrame, links: DataFrame, most_links: int | None = None, most_labels: int | None = None) -> DataFrame:
    """``labels`` (node, label) after the links ``a``, ``b`` between labels are drawn together.

    Each label moves to its smallest neighbour, links follow, until no link is left. Ids are
    hashes, so chains of falling ids are short. A label without links keeps its name.
    ``most_links`` and ``most_labels`` are numbers of rows, if known.
    """
    steps = []
    links = settled(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), most_links)
    while left := links.count():
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = settled(both.groupBy("a").agg(F.min("b").alias("to")).select(F.col("a").alias("label"), F.least("a", "to").alias("to")), 2 * left)
        steps.append(moves)
        first, second = (moves.select(F.col("label").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab")
        moved = links.join(first, "a").join(second, "b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        links = settled(moved.where("a <> b").distinct(), left)
    for moves in steps:
        labels = labels.join(moves, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return settled(labels, most_labels) if steps else labels


def _labelled(rows: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    """``rows`` with the label of a node; a node without one is its own."""
    known = labels.select(F.col("node").alias(node), F.col("label").alias("_label"))
    return rows.join(known, node, "left").withColumn(label, F.coalesce("_label", node)).drop("_label")


def _open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``bucket``, ``node``, ``label`` of the buckets that hold several classes."""
    most = members.count()
    known = settled(_labelled(members.select("bucket", "node"), labels, "node", "label"), most)
    several = known.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return settled(known.join(several.select("bucket"), "bucket"), most)


def _between_classes(opened: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b``: one node of each class of a bucket with one node of its largest class."""
    classes = opened.groupBy("bucket", "label").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("n"))
    core = classes.groupBy("bucket").agg(F.max_by(F.struct("label", "node"), F.struct("n", "label")).alias("core"))
    met = classes.join(core, "bucket").where(F.col("label") != F.col("core.label"))
    return met.select(F.greatest("node", "core.node").alias("a"), F.least("node", "core.node").alias("b")).distinct()


def links_between(own: list[dict], others: list[dict], threshold: float) -> list[tuple[int, int]]:
    """Of each own node and each other class one link to a similar node, if there is any. Nodes are ``node``, ``label``, ``elements`` (sorted)."""
    sets = [np.frombuffer(x["elements"], np.uint64) for x in own]
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    sizes, labels = np.array([len(x) for x in sets]), np.array([x["label"] for x in own], np.int64)
    found: dict[tuple[int, int], int] = {}
    for other in others:
        theirs = np.frombuffer(other["elements"], np.uint64)
        low, high = np.searchsorted(flat, theirs, side="left"), np.searchsorted(flat, theirs, side="right")
        met = high - low
        ends = np.cumsum(met)
        common = np.bincount(owner[np.arange(ends[-1]) + np.repeat(low - (ends - met), met)], minlength=len(sets))
        near = (labels != other["label"]) & (common + 1e-9 >= threshold * (sizes + len(theirs) - common))
        for i in np.flatnonzero(near).tolist():
            found.setdefault((own[i]["node"], other["label"]), other["node"])
    return [(max(a, b), min(a, b)) for (a, _), b in found.items()]


def close_pairs(nodes: list[int], labels: list[int], shorts: list[bytes], least: float = CLOSE) -> list[tuple[int, int]]:
    """Pairs ``a > b`` of nodes of different labels whose short signatures agree on that share of places."""
    table = np.array([np.frombuffer(x, np.uint8) for x in shorts])
    names, classes, found = np.array(nodes, np.int64), np.array(labels, np.int64), []
    for i in range(len(names) - 1):
        same = (table[i + 1 :] == table[i]).mean(axis=1) >= least
        for j in (i + 1 + np.flatnonzero(same & (classes[i + 1 :] != classes[i]))).tolist():
            found.append((max(nodes[i], nodes[j]), min(nodes[i], nodes[j])))
    return found


def _close_in_small(opened: DataFrame, elements: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of nodes of different classes of a small bucket that may be similar."""
    rows = opened.join(elements.select("node", "short"), "node")
    held = rows.groupBy("bucket").agg(F.collect_list("node").alias("nodes"), F.collect_list("label").alias("labels"), F.collect_list("short").alias("shorts"))

    def compare(batches):
        for batch in batches:
            found = [p for row in zip(*(batch.column(c).to_pylist() for c in ("nodes", "labels", "shorts"))) for p in close_pairs(*row)]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])

    return held.select("nodes", "labels", "shorts").mapInArrow(compare, "a bigint, b bigint").distinct()


def _compared_in_blocks(opened: DataFrame, elements: DataFrame, threshold: float) -> DataFrame:
    """Links ``a``, ``b`` between the nodes of different classes that share a bucket."""
    size = elements.select("node", F.octet_length("elements").alias("bytes"))
    most = opened.count()
    sized = settled(opened.join(size, "node"), most)
    per_label = sized.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    core = F.max(F.struct("n", "label", "bytes"))
    per_bucket = per_label.groupBy("bucket").agg(core["label"].alias("core"), F.sum("bytes").alias("bytes"), (F.sum("bytes") - core["bytes"]).alias("outside"))
    dealt = sized.select("bucket", "node", "label").join(settled(per_bucket, most), "bucket")

    def blocks(side: str, rows: DataFrame, total: str) -> DataFrame:
        """Nodes are dealt by hash into as many blocks as their bytes ask for."""
        block = F.pmod(F.xxhash64("node", F.lit(side)), F.ceil(F.col(total) / BLOCK_BYTES))
        placed = settled(rows.select("bucket", block.alias("block"), "node", "label"), most)
        whole = placed.join(elements, "node").groupBy("bucket", "block")
        return whole.agg(F.collect_list(F.struct("node", "label", "elements")).alias(side)).select("bucket", side)

    own, others = settled(blocks("own", dealt.where(F.col("label") != F.col("core")), "outside")), settled(blocks("others", dealt, "bytes"))

    def compare(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                found = links_between(batch.column("own")[i].as_py(), batch.column("others")[i].as_py(), threshold)
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])

    return settled(own.join(others, "bucket").select("own", "others").mapInArrow(compare, "a bigint, b bigint"))


def _joined(labels: DataFrame, found: DataFrame) -> DataFrame:
    """``labels`` after the links found between nodes, some of which may have no label yet."""
    ends = found.select(F.col("a").alias("node")).union(found.select("b")).distinct()
    links = found.count()
    most = labels.count() + 2 * links
    every = settled(labels.union(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))), most)
    between = _labelled(_labelled(found, every, "a", "la"), every, "b", "lb")
    return contract(every, between.select(F.col("la").alias("a"), F.col("lb").alias("b")), links, most)


def duplicate_nodes(nodes: DataFrame, docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``node``, ``label``: the class of each node that is linked to another. ``nodes`` has ``node`` and ``bands``; ``docs`` the texts."""
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "leader")
    members = settled(banded.join(shared, "bucket"))
    wanted = docs.sparkSession.sparkContext.broadcast(_wanted_bitmap(members.select("node").distinct()))
    emitted = docs.select("text").mapInArrow(lambda batches: _node_elements(wanted.value)(batches), "node bigint, elements binary, short binary")
    elements = settled(emitted.groupBy("node").agg(F.first("elements").alias("elements"), F.first("short").alias("short")))

    tried = settled(members.where("node <> leader").groupBy(F.col("node").alias("a")).agg(F.min("leader").alias("b")), members.count())
    links = _verified(tried, elements, threshold)
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    number = links.count()
    labels = contract(ends.select("node", F.col("node").alias("label")), links, number, 2 * number)

    opened = _open_members(members, labels)
    while not opened.isEmpty():
        pairs = settled(_between_classes(opened).join(tried, ["a", "b"], "left_anti"), opened.count())
        found = _verified(pairs, elements, threshold)
        if found.isEmpty():
            break
        tried = tried.union(pairs)
        labels = _joined(labels, found)
        opened = _open_members(opened, labels)
    if opened.isEmpty():
        return labels
    most = opened.count()
    sizes = settled(opened.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), most)
    few, many = (settled(opened.join(sizes.where(c).select("bucket"), "bucket"), most) for c in (F.col("n") <= FEW_NODES, F.col("n") > FEW_NODES))
    pairs = settled(_close_in_small(few, elements).join(tried, ["a", "b"], "left_anti"))
    found = _verified(pairs, elements, threshold)
    if not many.isEmpty():
        found = settled(found.union(_compared_in_blocks(many, elements, threshold)))
    return labels if found.isEmpty() else _joined(labels, found)


def document_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row per document: ``id``, ``text_hash``, ``class_id`` (the smallest id of the class), ``class_size``, ``keep``.

    ``keep`` holds for the rows of one id and text of each class, which may be repeated rows.
    """
    given = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    id_type = given.schema["id"].dataType.simpleString()
    sketches = settled(given.mapInArrow(_sketch, f"id {id_type}, text_hash bigint, node bigint, bands array<bigint>"))
    worded = sketches.where(F.col("node").isNotNull())
    nodes = worded.groupBy("node").agg(F.first("bands").alias("bands"))
    labels = duplicate_nodes(nodes, given, threshold)
    least = worded.groupBy("node").agg(F.min(F.struct("id", "text_hash")).alias("least"), F.count(F.lit(1)).alias("n"))
    most = sketches.count()
    classed = settled(_labelled(least, labels, "node", "label"), most)
    named = classed.groupBy("label").agg(F.min("least").alias("first"), F.sum("n").alias("class_size"))
    of_node = settled(classed.select("node", "label").join(named, "label").select("node", "first", "class_size"), most)
    found = worded.join(of_node, "node").select(
        "id", "text_hash", F.col("first.id").alias("class_id"), "class_size",
        (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.text_hash"))).alias("keep"),
    )
    alone = sketches.where(F.col("node").isNull())
    return found.union(alone.select("id", "text_hash", F.col("id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"), F.lit(True).alias("keep")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row per document: its id, the id of its class and the size of the class."""
    classes = document_classes(docs, doc_id, text, threshold)
    return classes.select(F.col("id").alias(doc_id), "class_id", "class_size", (F.col("class_size") > 1).alias("has_duplicates"))


_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def keep_one_per_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class, and all documents without words, with the columns they came with.

    Documents meet the list of those that go by id and text hash. Of repeated rows of the
    document that stays, one stays; the texts of such rows are shuffled, after each task
    has left one of each, and no others (of more than ``SENT_PAIRS`` documents on the list, theirs too).
    """
    classes = settled(document_classes(docs, doc_id, text, threshold).where("class_size > 1"))
    gone = classes.where(~F.col("keep")).select("id", "text_hash")
    repeated = classes.where("keep").groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "text_hash")
    special = settled(gone.withColumn("gone", F.lit(True)).union(repeated.withColumn("gone", F.lit(False))).distinct(), classes.count())
    marked = as_rows(docs).select("row", F.col(f"row.{doc_id}").alias("id"), F.xxhash64(f"row.{text}").alias("text_hash"))
    has_word = F.coalesce(F.col(f"row.{text}").rlike(_WORD), F.lit(False))
    plain, looked_up = _parted(marked.where(has_word), special)
    met = special.withColumnsRenamed({"id": "_id", "text_hash": "_hash"})
    listed = looked_up.join(F.broadcast(met) if plain is None else met, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    once, several = listed.where("gone is null"), listed.where("not gone").groupBy("id", "text_hash").agg(F.first("row").alias("row"))
    parts = [once, several, marked.where(~has_word), *([] if plain is None else [plain])]
    return reduce(DataFrame.union, [part.select("row.*") for part in parts])


def _parted(rows: DataFrame, special: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """``rows`` that are surely not among the ``special`` ids and text hashes, and the others.

    Up to ``SENT_PAIRS`` special ones can be sent to the rows: then there is only one part. More are known by
    a bitmap of bounded size, so that only the rows it lets through are shuffled with their texts.
    """
    count = special.count()
    if count <= SENT_PAIRS:
        return None, rows
    code = F.xxhash64("id", "text_hash").alias("code")
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(special.select(code), count))

    def mark(batches):
        for batch in batches:
            found = is_set(shared.value, batch.column("code").to_numpy(zero_copy_only=False).view(np.uint64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], [*batch.schema.names[:-1], "found"])

    coded = rows.select("*", code)
    schema = coded.drop("code").withColumn("found", F.lit(True)).schema
    marked = coded.mapInArrow(mark, schema)
    return marked.where("not found").drop("found"), marked.where("found").drop("found")
