"""Phrases whose words stand together more often than chance, by marginalising the longest windows.

Texts are cut at punctuation and line ends into pieces, pieces at blanks into words. At each word a
lead window has the word and the four after it in its piece as columns, padded where the piece ends.
Only these longest windows are counted. A phrase of ``k`` words occurs as often as the windows that
begin with it, so Spark's ``ROLLUP`` over the columns gives the counts of all shorter phrases.

Words travel as 64-bit codes that carry their language. Two passes come first. The first one counts
words; the second counts lead windows of two words. A phrase that is frequent has only frequent words
and frequent neighbours, so the longest windows end before a rare word or pair: this changes no count
that matters. Frequent words and pairs are known in tasks by a bitmap of bounded size, which lets some
others through at most. Tasks add up equal windows before they are shuffled; the shuffles are by
language and window, so a language with most of the rows is spread over all tasks.

Defined cases: a null text has no words; a null language is ``und``; repeated rows count as often as
they stand; ties in score and count are ranked by the phrase's UTF-8 bytes. Words are equal if their
codes are; a second hash of each word finds codes shared by two words, and other codes are then taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ledgerloom.session import settled

from .text import bitmap, flat_bytes, is_set, mix64, pieces, span_hashes, word_spans

ORDER, LEAST, TOP, SCALE, ABSORBED_PERCENT = 5, 100, 2000, 1000, 100
HELD_ROWS = 1_000_000
"""Counted rows that a task holds. Beyond, equal ones are drawn together; they are emitted once three quarters of it differ."""

_ENDS = np.zeros(256, dtype=bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IS_WORD = ~_ENDS
_IS_WORD[[0x20, 0x09]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_OTHER = np.random.default_rng(2).permutation(256).astype(np.uint8)
_PAIR, _LANG = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Words:
    """The words of some texts: codes, languages, and whether the next word is in the same piece."""

    def __init__(self, data: np.ndarray, edges: np.ndarray, langs: np.ndarray, lang_hashes: np.ndarray, salt: int):
        self.bytes = _LOWER[data]
        self.starts, self.ends, rows = word_spans(self.bytes, edges, _IS_WORD)
        row = np.repeat(np.arange(len(edges) - 1), np.diff(rows))
        self.lang = langs[row]
        plain = span_hashes(self.bytes, self.starts, self.ends)
        if salt:
            plain += np.uint64(salt) * self.other_hashes()
        self.code = np.maximum(mix64(plain + mix64(lang_hashes ^ _LANG)[self.lang]), np.uint64(1))  # zero pads
        passed = np.concatenate(([0], np.cumsum(_ENDS[self.bytes])))
        self.joined = np.zeros(len(row), bool)
        if len(row):
            self.joined[:-1] = (row[1:] == row[:-1]) & (passed[self.starts[1:]] == passed[self.ends[:-1]])

    def other_hashes(self) -> np.ndarray:
        return span_hashes(_OTHER[self.bytes], self.starts, self.ends)

    def spelling(self, which: np.ndarray) -> list[bytes]:
        return [self.bytes[a:b].tobytes() for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist())]


def pair_codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix64(left * _PAIR + right)


def lead_windows(codes: np.ndarray, joined: np.ndarray, order: int) -> list[np.ndarray]:
    """Columns of the codes 0 to ``order - 1`` places on, zero beyond the end of the piece."""
    columns, alive = [codes], np.ones(len(codes), bool)
    for step in range(1, order):
        alive = alive & np.concatenate((joined[step - 1 :], np.zeros(step - 1, bool)))[: len(codes)]
        ahead = np.zeros_like(codes)
        ahead[:-step] = codes[step:]
        columns.append(np.where(alive, ahead, 0).astype(np.uint64))
    return columns


def tally(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows drawn together, their counts added. Rows may come twice if two kinds share a hash."""
    if not len(counts):
        return columns, counts
    key = np.zeros(len(counts), np.uint64)
    for column in columns:
        key = mix64(key * np.uint64(3) + column.astype(np.uint64))
    order = np.argsort(key)
    columns = [c[order] for c in columns]
    fresh = np.ones(len(order), bool)
    fresh[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    first = np.flatnonzero(fresh)
    return [c[first] for c in columns], np.add.reduceat(counts[order], first)


def _counting(names: list[str], select, salt: int):
    """Batches of ``lang`` and ``text`` in, counted rows of the named columns out; ``select`` makes them of ``Words``, ``lang`` first if named."""

    def emit(batches):
        langs: dict[str, int] = {}
        held: list = []

        def drawn_together() -> int:
            columns = [np.concatenate(c) for c in zip(*(h[0] for h in held))]
            held[:] = [tally(columns, np.concatenate([h[1] for h in held]))]
            return len(held[0][1])

        def flushed():
            columns, counts = held.pop()
            spelt = pa.array(list(langs), pa.string())
            arrays = [spelt.take(pa.array(c)) if name == "lang" else pa.array(c.view(np.int64)) for name, c in zip(names, columns)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(counts)], [*names, "n"])

        for batch in batches:
            for piece, data, edges in pieces(batch, "text"):
                mine = np.array([langs.setdefault(x, len(langs)) for x in piece.column("lang").to_pylist()], np.int64)
                flat, at = flat_bytes(pa.array(list(langs), pa.string()))
                words = Words(data, edges, mine, span_hashes(flat, at[:-1], at[1:]), salt)
                columns = select(words)
                held.append(tally(columns, np.ones(len(columns[0]), np.int64)))
                if sum(len(h[1]) for h in held) > HELD_ROWS and drawn_together() > HELD_ROWS * 3 // 4:
                    yield flushed()
        if held:
            drawn_together()
            yield flushed()

    return emit


def _of_words(words: Words) -> list[np.ndarray]:
    return [words.lang, words.code, words.other_hashes() >> np.uint64(32)]


def _of_pairs(frequent):
    """Lead windows of two words, both frequent, as one code; languages are in the words' codes."""

    def select(words: Words) -> list[np.ndarray]:
        known = is_set(frequent.value, words.code)
        first, second = lead_windows(words.code, words.joined, 2)
        both = np.flatnonzero((second > 0) & known & np.concatenate((known[1:], [False]))[: len(known)])
        return [pair_codes(first[both], second[both])]

    return select


def _of_windows(frequent, pairs, order: int):
    """The longest windows at frequent words, ending before a rare word or pair."""

    def select(words: Words) -> list[np.ndarray]:
        known = is_set(frequent.value, words.code)
        ahead = np.concatenate((words.code[1:], np.zeros(1, np.uint64)))[: len(known)]
        joined = words.joined & known & np.concatenate((known[1:], [False]))[: len(known)] & is_set(pairs.value, pair_codes(words.code, ahead))
        some = np.flatnonzero(known)
        return [words.lang[some], *(c[some] for c in lead_windows(words.code, joined, order))]

    return select


def _spelling(wanted, salt: int):
    """Batches in; the wanted words with their spelling out, each once per task."""

    def emit(batches):
        known = np.zeros(0, np.uint64)
        for batch in batches:
            for piece, data, edges in pieces(batch, "text"):
                names = sorted(set(piece.column("lang").to_pylist()))
                flat, at = flat_bytes(pa.array(names, pa.string()))
                place = {x: i for i, x in enumerate(names)}
                mine = np.array([place[x] for x in piece.column("lang").to_pylist()], np.int64)
                words = Words(data, edges, mine, span_hashes(flat, at[:-1], at[1:]), salt)
                hit = np.flatnonzero(is_set(wanted.value, words.code))
                first = hit[np.unique(words.code[hit], return_index=True)[1]]
                first = first[~np.isin(words.code[first], known)]
                known = np.concatenate((known, words.code[first]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()).take(pa.array(words.lang[first])), pa.array(words.code[first].view(np.int64)),
                     pa.array(words.spelling(first), pa.binary()).cast(pa.string())],
                    ["lang", "word", "spelling"],
                )

    return emit


def _word_counts(given: DataFrame) -> tuple[DataFrame, int]:
    """``lang``, ``word``, ``n`` of all words, under a salt for which no code stands for two words."""
    salt = 0
    while True:
        counted = given.mapInArrow(_counting(["lang", "word", "check"], _of_words, salt), "lang string, word bigint, check bigint, n bigint")
        words = settled(counted.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.min("check").alias("low"), F.max("check").alias("high")))
        if words.where("low <> high").isEmpty():
            return words.select("lang", "word", "n"), salt
        salt += 1


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, order: int = ORDER) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """``lang``, ``phrase`` (codes), ``f`` of all phrases that occur ``least`` times; the word counts; the texts read; the salt."""
    spark = docs.sparkSession
    given = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    words, salt = _word_counts(given)

    def sent(codes: DataFrame):
        return spark.sparkContext.broadcast(bitmap(codes, codes.count()))

    frequent = sent(words.where(F.col("n") >= least).select(F.col("word").alias("code")))
    twos = given.mapInArrow(_counting(["code"], _of_pairs(frequent), salt), "code bigint, n bigint")
    pairs = sent(settled(twos.groupBy("code").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("code")))
    names = [f"w{k}" for k in range(order)]
    schema = "lang string, " + ", ".join(f"{n} bigint" for n in names) + ", n bigint"
    windows = given.mapInArrow(_counting(["lang", *names], _of_windows(frequent, pairs, order), salt), schema)
    summed = spark.sql(
        f"SELECT lang, {', '.join(names)}, sum(n) AS f FROM {{windows}} GROUP BY lang, ROLLUP ({', '.join(names)}) HAVING sum(n) >= {int(least)}",
        windows=windows,
    )
    phrase = F.filter(F.array(*names), lambda w: w.isNotNull())  # rolled-up columns are null, padding is zero
    phrases = summed.select("lang", phrase.alias("phrase"), "f").where("size(phrase) > 0 and not array_contains(phrase, 0L)")
    return settled(phrases), words, given, salt


def scored_phrases(phrases: DataFrame, totals: DataFrame, percent: int = ABSORBED_PERCENT) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of the phrases of two words or more that no longer one absorbs.

    One more word is enough to look at: what a longer phrase absorbs, the phrases between absorb too.
    """
    candidates = phrases.where("size(phrase) > 1")
    parts = F.array(F.expr("slice(phrase, 1, size(phrase) - 1)"), F.expr("slice(phrase, 2, size(phrase) - 1)"))
    longer = candidates.where("size(phrase) > 2").select("lang", F.explode(parts).alias("phrase"), "f")
    longer = settled(longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    alone = candidates.join(longer, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {int(percent)} * f").drop("longer")
    cuts = settled(alone.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(phrase) - 1)")).alias("cut")))
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    cuts = cuts.withColumn("left", F.expr("slice(phrase, 1, cut)")).withColumn("right", F.expr("slice(phrase, cut + 1, size(phrase) - cut)"))
    met = settled(cuts.join(left, ["lang", "left"]).select("lang", "phrase", "a", "cut", "right", "l").join(right, ["lang", "right"]))
    whole = {c: F.col(c).cast("decimal(38,0)") for c in "anlr"}
    exact = (F.lit(SCALE).cast("decimal(4,0)") * whole["a"] * whole["n"]).cast("decimal(38,0)"), (whole["l"] * whole["r"]).cast("decimal(38,0)")
    scored = met.join(totals, "lang").withColumn("above", exact[0]).withColumn("below", exact[1]).withColumn("score", F.expr("above div below"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"), F.first("a").alias("a"), F.first("n").alias("n"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, order: int = ORDER, top: int = TOP, percent: int = ABSORBED_PERCENT) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    phrases, words, given, salt = phrase_counts(docs, text, lang, least, order)
    totals = settled(words.groupBy("lang").agg(F.sum("n").alias("n")))
    scored = scored_phrases(phrases, totals, percent)
    order_of = [F.desc("score"), F.desc("a")]
    scored = settled(scored.withColumn("at", F.rank().over(W.partitionBy("lang").orderBy(*order_of))).where(F.col("at") <= top).drop("at"))
    used = settled(scored.select(F.explode("phrase").alias("code")).distinct())
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(used, used.count()))
    spelt = given.mapInArrow(_spelling(wanted, salt), "lang string, word bigint, spelling string").groupBy("lang", "word").agg(F.first("spelling").alias("spelling"))
    each = scored.select("*", F.posexplode("phrase").alias("place", "word")).join(spelt, ["lang", "word"])
    text_of = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "spelling"))), lambda s: s["spelling"]), " ")
    numbers = ["a", "l", "r", "n", "score"]
    named = each.groupBy("lang", F.col("phrase").alias("codes")).agg(text_of.alias("phrase"), *[F.first(c).alias(c) for c in numbers])
    place = F.row_number().over(W.partitionBy("lang").orderBy(*order_of, F.asc("phrase")))
    ranked = named.withColumn("rank", place).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", *numbers)
