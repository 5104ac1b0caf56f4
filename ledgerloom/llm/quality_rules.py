"""Quality rules: plain counts of each text, and its fertility under a public vocabulary.

Base counts use words ``[^\\x20\\x09-\\x0D]+``. The verdict measures how the vocabulary takes
to the text: characters per token, the share of tokens that spell single bytes, and the
entropy of the tokens in bits. Each language and script has a band; a text is rejected
outside the band of its language and commonest script.

Bands are measured over all texts that pass the base rules, equal texts counting once: the
quartiles, and ``WIDTHS`` times their distance beyond them. Values are counted in steps of
``1 / STEPS`` first, so the driver gets a table bounded by the vocabulary and the number of
languages, which must be small. A language and script of fewer than ``LEAST_TEXTS`` texts has
no measured band and falls back to the wide one of ``SCRIPTS``.

Texts are tokenized once; the measures are written to ``spark.checkpoint.dir``, and one small
row a text is shuffled. The vocabulary is read on the driver and broadcast, its size is fixed
by the file. Defined cases: a null text counts as empty; a text of fewer than ``MIN_WORDS``
words fails the base rules, so empty ones do; a text without letters falls under ``OTHER``;
a null language is a group of its own; repeated rows are judged each. Memory follows
``text.PIECE_BYTES`` or the longest single text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.session import settled

from .text import mix64, pieces, span_hashes, word_spans

MIN_WORDS, REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
LEAST_TEXTS, STEPS, MOST_BANDS = 50, 1000, 1000
#: How far beyond the quartiles a band goes, in their distances, and how far at least. Byte shares are skewed.
WIDTHS = {"chars_per_token": (2.0, 0.05), "byte_share": (3.0, 0.01), "entropy": (2.0, 0.25)}

_NOT_SPACE = np.ones(256, dtype=bool)
_NOT_SPACE[[32, *range(9, 14)]] = False
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Band:
    """What a script's texts may measure."""

    least_chars_per_token: float
    most_chars_per_token: float
    most_byte_share: float
    least_entropy: float


OTHER = "other"
#: First and last code point of each script's main blocks, and its band where too few texts are there to measure one.
SCRIPTS = {
    "latin": ([(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)], Band(1.3, 12.0, 0.15, 2.0)),
    "greek": ([(0x370, 0x3FF)], Band(0.8, 12.0, 0.3, 2.0)),
    "cyrillic": ([(0x400, 0x52F)], Band(1.0, 12.0, 0.15, 2.0)),
    "arabic": ([(0x600, 0x6FF), (0x750, 0x77F)], Band(0.6, 12.0, 0.4, 2.0)),
    "han": ([(0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF)], Band(0.35, 8.0, 0.85, 2.0)),
    "hangul": ([(0xAC00, 0xD7AF), (0x1100, 0x11FF)], Band(0.35, 8.0, 0.85, 2.0)),
    "hebrew": ([(0x590, 0x5FF)], Band(0.25, 12.0, 1.0, 2.0)),
    "devanagari": ([(0x900, 0x97F)], Band(0.25, 12.0, 1.0, 2.0)),
    "thai": ([(0xE00, 0xE7F)], Band(0.25, 12.0, 1.0, 2.0)),
    OTHER: ([], Band(0.25, 12.0, 1.0, 2.0)),
}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _per_row(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many flags are set in each row."""
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[edges])


def repeated_words(hashes: np.ndarray, rows: np.ndarray, width: int = REPEAT_WINDOW) -> np.ndarray:
    """Per row, the words inside a window of ``width`` words that its text has twice or more."""
    out = np.zeros(len(rows) - 1, np.int64)
    if len(hashes) < width:
        return out
    owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    starts = np.flatnonzero(owner[: len(hashes) - width + 1] == owner[width - 1 :])
    key = mix64(owner[starts].astype(np.uint64) + np.uint64(0x51ED270B))
    for step in range(width):
        key = mix64(key * np.uint64(3) + hashes[starts + step])
    _, which, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = starts[counts[which] > 1]
    ramp = np.zeros(len(hashes) + 1, np.int64)
    ramp[twice] += 1
    np.add.at(ramp, twice + width, -1)
    return _per_row(np.cumsum(ramp[:-1]) > 0, rows)


def duplicate_lines(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Per row, the lines with a word that equal an earlier line of their text."""
    rows = len(edges) - 1
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate((edges[:-1], breaks + 1))
    owner = np.concatenate((np.arange(rows), np.searchsorted(edges, breaks, side="right") - 1))
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    ends = np.append(starts[1:] - 1, 0)
    ends[np.append(owner[1:] != owner[:-1], True)] = edges[1:]
    filled = np.concatenate(([0], np.cumsum(_NOT_SPACE[data])))
    worded = filled[ends] > filled[starts]
    starts, ends, owner = starts[worded], ends[worded], owner[worded]
    key = mix64(owner.astype(np.uint64) + np.uint64(0xA5A5)) ^ span_hashes(data, starts, ends)
    first = np.unique(key, return_index=True)[1]
    return np.bincount(owner, minlength=rows) - np.bincount(owner[first], minlength=rows)


def base_counts(data: np.ndarray, edges: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each row."""
    starts, ends, rows = word_spans(data, edges, _NOT_SPACE)
    point = (data & 0xC0) != 0x80
    return {
        "n_words": np.diff(rows),
        "word_chars": _per_row(point & _NOT_SPACE[data], edges),
        "n_symbols": _per_row(_SYMBOL[data], edges),
        "n_dup_lines": duplicate_lines(data, edges),
        "n_repeat_words": repeated_words(span_hashes(data, starts, ends), rows),
    }


def fertility(texts: list[str], processor, byte_ids: np.ndarray, size: int) -> dict[str, np.ndarray]:
    """Tokens, characters per token, byte share and entropy of each text; zeros for a text without tokens."""
    encoded = processor.encode(texts, num_threads=1)
    counts = np.array([len(ids) for ids in encoded], dtype=np.int64)
    flat = np.fromiter((i for ids in encoded for i in ids), np.int64, int(counts.sum()))
    owner = np.repeat(np.arange(len(texts)), counts)
    some = np.maximum(counts, 1)
    pairs, times = np.unique(owner * size + flat, return_counts=True)
    share = times / some[pairs // size]
    return {
        "n_tokens": counts,
        "chars_per_token": np.array([len(t) for t in texts]) / some,
        "byte_share": np.bincount(owner, byte_ids[flat], minlength=len(texts)) / some,
        "entropy": np.bincount(pairs // size, -share * np.log2(share), minlength=len(texts)),
    }


def scripts(texts: list[str], names: list[str]) -> np.ndarray:
    """The number of the commonest script of each text; the first named wins a tie."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    edges = np.cumsum([0, *map(len, texts)])
    counts = np.zeros((len(names), len(texts)), np.int64)
    for at, name in enumerate(names):
        for low, high in SCRIPTS[name][0]:
            counts[at] += _per_row((points >= low) & (points <= high), edges)
    counts[names.index(OTHER)] = (counts.sum(axis=0) == 0).astype(np.int64)
    return counts.argmax(axis=0)


_COLUMNS = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64(), "base_failed": pa.bool_(),
    "n_tokens": pa.int64(), "chars_per_token": pa.float64(), "byte_share": pa.float64(), "entropy": pa.float64(), "script": pa.string(),
}


def measures(docs: DataFrame, text: str = "text", path: str | None = None, language: str | None = "lang", carried: list[str] | None = None) -> DataFrame:
    """``row`` (the ``carried`` columns, or all), ``language``, ``digest`` of the text, and ``_COLUMNS``; one pass."""
    with open(path or default_vocabulary(), "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    names = list(SCRIPTS)
    spoken = F.col(f"`{language}`").cast("string") if language in docs.columns else F.lit(None).cast("string")
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried or docs.columns]).alias("row"), spoken.alias("language"), F.xxhash64(whole).alias("digest"), F.col(f"`{text}`").alias("text"))
    kinds = {pa.int64(): F.lit(0).cast("bigint"), pa.bool_(): F.lit(True), pa.float64(): F.lit(0.0), pa.string(): F.lit("")}
    kept = ["row", "language", "digest"]
    schema = rows.select(*kept, *[kinds[kind].alias(name) for name, kind in _COLUMNS.items()]).schema

    def measure(batches):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        size = processor.get_piece_size()
        byte_ids = np.array([processor.is_byte(i) for i in range(size)], dtype=np.float64)
        for batch in batches:
            for piece, data, edges in pieces(batch, "text"):
                texts = piece.column("text").fill_null("").to_pylist()
                out = base_counts(data, edges) | fertility(texts, processor, byte_ids, size)
                out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > REPEAT_PERCENT * out["n_words"])
                out["script"] = [names[i] for i in scripts(texts, names)]
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in kept], *[pa.array(out[name], kind) for name, kind in _COLUMNS.items()]], [*kept, *_COLUMNS])

    return rows.mapInArrow(measure, schema)


def _quartiles(counted: list[tuple[int, int]]) -> tuple[float, float]:
    """The steps at a quarter and three quarters of the texts, as values."""
    steps, times = np.array(sorted(counted)).T
    upto = np.cumsum(times)
    return tuple(float(steps[np.searchsorted(upto, share * upto[-1])]) / STEPS for share in (0.25, 0.75))


def learn_bands(measured: DataFrame) -> dict[tuple[str | None, str], Band]:
    """The band of each language and script with ``LEAST_TEXTS`` different texts that pass the base rules; of the ``MOST_BANDS`` commonest."""
    steps = [F.round(F.col(name) * STEPS).cast("bigint").alias(name) for name in WIDTHS]
    once = measured.where("not base_failed").select("language", "script", "digest", *steps).distinct()
    once = settled(once)
    common = once.groupBy("language", "script").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_TEXTS)
    common = F.broadcast(common.orderBy(F.desc("n"), "language", "script").limit(MOST_BANDS).select(F.col("language").alias("_language"), F.col("script").alias("_script")))
    once = once.join(common, F.col("language").eqNullSafe(F.col("_language")) & (F.col("script") == F.col("_script")), "left_semi")
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), F.col(name).alias("step")) for name in WIDTHS])).alias("x")
    counted: dict[tuple, dict[str, list]] = {}
    for r in once.select("language", "script", each).groupBy("language", "script", "x.measure", "x.step").count().collect():
        counted.setdefault((r["language"], r["script"]), {name: [] for name in WIDTHS})[r["measure"]].append((r["step"], r["count"]))
    bands = {}
    for group, by_measure in counted.items():
        reach = {}
        for name, (width, least) in WIDTHS.items():
            low, high = _quartiles(by_measure[name])
            beyond = max(width * (high - low), least)
            reach[name] = (low - beyond, high + beyond)
        bands[group] = Band(*reach["chars_per_token"], reach["byte_share"][1], reach["entropy"][0])
    return bands


def _outside(learned: dict[tuple[str | None, str], Band], given: dict[str, Band]) -> Column:
    """The names of the measures that lie outside the row's band."""
    limits = lambda b: F.array(*map(F.lit, (float(b.least_chars_per_token), float(b.most_chars_per_token), float(b.most_byte_share), float(b.least_entropy))))
    table = lambda bands: F.create_map(*[x for key, band in bands for x in (F.lit(key), limits(band))])
    named = lambda language, script: f"{script} {'' if language is None else '=' + language}"
    own = [(named(*group), band) for group, band in sorted(learned.items(), key=str) if group[1] not in given]
    wide = F.try_element_at(table([(script, given.get(script, band)) for script, (_, band) in SCRIPTS.items()]), F.col("script"))
    key = F.concat(F.col("script"), F.lit(" "), F.coalesce(F.concat(F.lit("="), F.col("language")), F.lit("")))
    band = F.coalesce(F.try_element_at(table(own), key), wide) if own else wide
    at = lambda i: F.get(band, F.lit(i))
    named_if = lambda name, bad: F.when(bad, F.lit(name))
    return F.array_compact(F.array(
        named_if("chars_per_token", (F.col("chars_per_token") < at(0)) | (F.col("chars_per_token") > at(1))),
        named_if("byte_share", F.col("byte_share") > at(2)), named_if("entropy", F.col("entropy") < at(3)),
    ))


def _judged(measured: DataFrame, bands: dict[str, Band] | None) -> DataFrame:
    measured = settled(measured)
    marked = measured.withColumn("outside", _outside(learn_bands(measured), bands or {}))
    return marked.select("row", *_COLUMNS, (~F.col("base_failed") & (F.size("outside") == 0)).alias("kept"), "language", "outside")


def quality_rules(docs: DataFrame, text: str = "text", path: str | None = None, bands: dict[str, Band] | None = None, language: str | None = "lang") -> DataFrame:
    """``row`` (the document as it came), the base counts, the fertility measures, the verdict, and in ``outside`` the
    measures outside the band. ``bands`` sets scripts by hand; without a column ``language`` bands are by script only."""
    return _judged(measures(docs, text, path, language), bands)


def rejections(judged: DataFrame) -> DataFrame:
    """One row per language and script: texts, those the base rules fail, and of the others how many each band rejects."""
    passed = ~F.col("base_failed")
    by_measure = [F.count_if(passed & F.array_contains("outside", name)).alias(name) for name in WIDTHS]
    return judged.groupBy("language", "script").agg(F.count(F.lit(1)).alias("texts"), F.count_if("base_failed").alias("base_failed"), *by_measure, F.count_if(passed & ~F.col("kept")).alias("rejected"))


def quality_rules_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per document: base counts, verdict, then the measures behind it."""
    judged = _judged(measures(docs, text, path, carried=[doc_id]), None)
    first = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(F.col(f"row.{doc_id}").alias(doc_id), *first, *[c for c in _COLUMNS if c not in first])
