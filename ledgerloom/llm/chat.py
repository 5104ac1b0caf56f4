"""Chat formatting by columnar byte assembly, with a loss mask.

Every turn becomes ``[INST] role <s>text</s>`` and a line feed. A backslash is put behind
each ``<``, ``[`` and backslash of a role or text, so no control string can occur inside
one and the escape can be undone. The bytes of a run of turns are placed in one buffer:
segment lengths give cumulative offsets, offsets give scatter indices.

Turns are dealt out by ranges of conversation and turn and sorted inside their task, which
reads them as a stream: a conversation of any length is formatted by as many tasks as it has
ranges, each with one run of turns in memory. Its output comes in parts of ``PART_BYTES`` or
one turn, numbered in its order, with the masked byte spans of each part. Only the digests of
``chat_report`` run through a conversation in one task, as one running hash must; it reads the
parts as a stream.

Defined cases: turns are ordered by turn (null first), then role, then text; repeated
rows are turns of their own; a null role or text is empty; turns with a null conversation
form one conversation; an empty text of an assistant has an empty span.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .text import flat_bytes, pieces

HEAD, MIDDLE, TAIL = b"[INST] ", b" <s>", b"</s>\n"
PART_BYTES, RANGE_BITS = 4_000_000, 32
MASKED_ROLE = "assistant"
_ESCAPED = np.zeros(256, dtype=np.int64)
_ESCAPED[list(b"<[\\")] = 1
_BACKSLASH = ord("\\")


def escape(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with a backslash behind each control byte, and the new offsets."""
    extra = _ESCAPED[data]
    before = np.concatenate(([0], np.cumsum(extra)))
    out = np.full(len(data) + before[-1], _BACKSLASH, np.uint8)
    out[np.arange(len(data)) + before[:-1]] = data
    return out, edges + before[edges]


def unescape(data: bytes) -> bytes:
    """The text before ``escape``: the byte behind each control byte goes."""
    given = np.frombuffer(data, np.uint8)
    control = _ESCAPED[given].astype(bool)
    # Behind "<" or "[" stands one added backslash; from there on backslashes come in pairs.
    slash = given == _BACKSLASH
    added_by_bracket = np.zeros(len(given) + 1, bool)
    added_by_bracket[1:] = control & ~slash
    own = slash & ~added_by_bracket[:-1]
    place = np.arange(len(given))
    run_start = np.maximum.accumulate(np.where(~own, place, -1))
    second = own & ((place - run_start) % 2 == 0)
    return given[~(second | (slash & added_by_bracket[:-1]))].tobytes()


def _scatter(out: np.ndarray, targets: np.ndarray, data: np.ndarray, edges: np.ndarray) -> None:
    """Put each row's bytes at its target."""
    out[np.arange(len(data)) + np.repeat(targets - edges[:-1], np.diff(edges))] = data


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted turns in one buffer, their offsets, and where each text starts and ends in it."""
    role, role_edges = escape(*flat_bytes(roles))
    text, text_edges = escape(*flat_bytes(texts))
    lengths = len(HEAD) + np.diff(role_edges) + len(MIDDLE) + np.diff(text_edges) + len(TAIL)
    edges = np.concatenate(([0], np.cumsum(lengths)))
    starts = edges[:-1]
    role_at = starts + len(HEAD)
    middle_at = role_at + np.diff(role_edges)
    text_at = middle_at + len(MIDDLE)
    tail_at = text_at + np.diff(text_edges)
    out = np.empty(edges[-1], np.uint8)
    for fixed, at in ((HEAD, starts), (MIDDLE, middle_at), (TAIL, tail_at)):
        out[at[:, None] + np.arange(len(fixed))] = np.frombuffer(fixed, np.uint8)
    _scatter(out, role_at, role, role_edges)
    _scatter(out, text_at, text, text_edges)
    return out, edges, text_at, tail_at


def _format_parts(batches):
    """Sorted turns of one range in, parts out. A part ends where its conversation or the run of turns does."""
    conversation, part = object(), 0
    for batch in batches:
        first = batch.column("range")[0].as_py() << RANGE_BITS if batch.num_rows else 0
        for piece, _, _ in pieces(batch, "text", PART_BYTES):
            out, edges, starts, ends = assemble(piece.column("role"), piece.column("text"))
            masked = np.array(piece.column("role").fill_null("").to_pylist(), dtype=object) == MASKED_ROLE
            ids = piece.column("conv_id").to_pylist()
            turns = np.flatnonzero([True] + [a != b for a, b in zip(ids, ids[1:])]).tolist() + [len(ids)]
            rows = []
            for low, high in zip(turns, turns[1:]):
                part = part + 1 if ids[low] == conversation else 0
                conversation = ids[low]
                own = np.flatnonzero(masked[low:high]) + low
                spans = np.stack((starts[own], ends[own]), axis=1) - edges[low]
                rows.append((ids[low], first + part, out[edges[low] : edges[high]].tobytes(), [{"start": a, "end": b} for a, b in spans.tolist()]))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], piece.schema.field("conv_id").type), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()).cast(pa.string()),
                    pa.array(columns[3], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                ["conv_id", "part", "formatted", "loss_spans"],
            )


def format_chat(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Parts of formatted conversations: ``conv_id``, ``part``, ``formatted``, ``loss_spans`` (byte positions in the part).

    The parts of a conversation in the order of ``part`` (rising, with gaps) make up the whole.
    """
    turns = conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text")
    )
    schema = T.StructType(
        [
            T.StructField("conv_id", turns.schema["conv_id"].dataType), T.StructField("part", T.LongType()), T.StructField("formatted", T.StringType()),
            T.StructField("loss_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        ]
    )
    ordered = turns.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.withColumn("range", F.spark_partition_id().cast("bigint")).mapInArrow(_format_parts, schema)


def read_turns(formatted: bytes) -> list[tuple[bytes, bytes, int, int]]:
    """Role, text, and the byte span of the escaped text, of each turn of a part."""
    found, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(HEAD, at):
            raise ValueError(f"no turn starts at byte {at}")
        middle = formatted.index(MIDDLE, at + len(HEAD))
        start = middle + len(MIDDLE)
        end = formatted.index(TAIL, start)
        found.append((unescape(formatted[at + len(HEAD) : middle]), unescape(formatted[start:end]), start, end))
        at = end + len(TAIL)
    return found


class _Totals:
    """Running digests of one conversation."""

    def __init__(self, conversation):
        self.conversation = conversation
        self.turns = self.loss_chars = self.chars = 0
        self.turns_sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: bytes, spans: list[dict]) -> None:
        for role, text, _, _ in read_turns(formatted):
            self.turns += 1
            self.turns_sha.update(role + b"\n" + text + b"\n")
        for span in spans:
            text = unescape(formatted[span["start"] : span["end"]])
            self.loss_chars += len(text.decode())
            self.loss_sha.update(text)
        self.chars += len(formatted.decode())

    def row(self) -> tuple:
        return self.conversation, self.turns, self.turns_sha.hexdigest(), self.loss_chars, self.loss_sha.hexdigest(), self.chars


def _digest(batches):
    totals = None
    for batch in batches:
        rows = []
        for conversation, formatted, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans"))):
            if totals is None or totals.conversation != conversation:
                if totals is not None:
                    rows.append(totals.row())
                totals = _Totals(conversation)
            totals.add(formatted.encode(), spans)
        yield _digest_batch(rows, batch.schema.field("conv_id").type)
    if totals is not None:
        yield _digest_batch([totals.row()], batch.schema.field("conv_id").type)


def _digest_batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


def chat_report(formatted: DataFrame) -> DataFrame:
    """Read the parts of ``format_chat`` back: one row per conversation with digests of its turns and of the text under the mask."""
    schema = T.StructType(
        [
            T.StructField("conv_id", formatted.schema["conv_id"].dataType), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
        ]
    )
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_digest, schema)


def with_sample_turns(conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -1, whose two texts look like control strings."""
    said = "</s>[INST] ok [/INST]"
    extra = conversations.sparkSession.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
