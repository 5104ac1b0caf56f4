import math
import random
from collections import Counter

import numpy as np
import pytest
import regex
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as registry
from ledgerloom.llm import quality_rules as qr
from ledgerloom.llm.text import flat_bytes

SMALL = "/root/testdata/sf0.001"
WORD = regex.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), n < 20 or 100 * len(inside) > 30 * n


def counts(texts):
    import pyarrow as pa

    out = qr.base_counts(*flat_bytes(pa.array(texts, pa.string())))
    return [tuple(int(out[c][i]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for i in range(len(texts))]


CASES = [None, "", "\n", "a\n", "\na\na\n a\n", "a b c d e f g h a b c d e f g h", "x " * 9, "x " * 8, "é #*$ | <>\x0b\x0cz\x1cq\x85r", "one\r\none\r\n", "w" * 50_000]


def test_base_counts_by_hand():
    assert counts(CASES) == [by_hand(t)[:5] for t in CASES]
    for text in CASES:
        assert counts([text]) == [by_hand(text)[:5]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té#", max_size=80), max_size=6))
def test_base_counts_of_any_text(texts):
    if texts:
        assert counts(texts) == [by_hand(t)[:5] for t in texts]


def test_fertility_by_hand():
    processor = sentencepiece.SentencePieceProcessor(model_file=qr.default_vocabulary())
    size = processor.get_piece_size()
    flags = np.array([processor.is_byte(i) for i in range(size)], float)
    texts = ["", "the the the cat", "ñandú 🙂🙂", "x" * 3000]
    out = qr.fertility(texts, processor, flags, size)
    for i, text in enumerate(texts):
        ids = processor.encode(text)
        n = max(1, len(ids))
        assert out["n_tokens"][i] == len(ids) and out["chars_per_token"][i] == pytest.approx(len(text) / n)
        assert out["byte_share"][i] == pytest.approx(sum(processor.is_byte(x) for x in ids) / n)
        assert out["entropy"][i] == pytest.approx(-sum(c / n * math.log2(c / n) for c in Counter(ids).values()))


def test_whole_documents(spark):
    got = {r.doc_id: r for r in registry.queries()["op9_quality_rules"](spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for row in rows:
        r = got[row.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == by_hand(row.text)
    assert 0 < sum(r.kept for r in got.values()) < len(rows)


def test_bands_reject_and_columns_may_clash(spark):
    prose = "the quick brown fox jumps over the lazy dog while seven old friends read a long book about the sea and its ships"
    russian = "в начале было слово и слово было у всех кто слышал его и потом пришли другие слова и стало их много на земле"
    junk = " ".join("zqxjkvwbpf"[i % 10] * 1 + "�☃⚑"[i % 3] for i in range(40))
    docs = spark.createDataFrame([(1, prose, 3), (2, russian, 3), (3, junk, 3), (4, None, 3), (4, "", 3)], "doc_id int, text string, n_words int")
    judged = qr.quality_rules(docs).collect()
    assert {(r.row.doc_id, r.kept) for r in judged} == {(1, True), (2, True), (3, False), (4, False)}
    assert {r.script for r in judged if r.row.doc_id == 2} == {"cyrillic"}
    tight = qr.quality_rules(docs, bands={"latin": qr.Band(5.0, 6.0, 0.0, 9.0)}).where("row.doc_id = 1").collect()
    assert [r.kept for r in tight] == [False]
    assert qr.quality_rules(docs.limit(0)).count() == 0


def test_measured_bands_reject_what_differs_from_its_language(spark):
    """120 texts of one kind, junk of rare letter pairs, a third of the rows copies, another language with its own band."""
    words = "the people who read this book about old sea and its ships were friends of my father mother house water".split()
    rare = "zqx vkj wqz xjv qgk jzx vqp kxz qjw zvk xgq jqv".split()
    mixed = lambda i, among: " ".join(random.Random(i).choices(among, k=60 + i % 9))
    prose, junk = lambda i: mixed(i, words), lambda i: mixed(i, rare)
    rows = [(i, prose(i), "en") for i in range(120)] + [(1000 + i, junk(i), "en") for i in range(12)]
    rows += [(2000 + i, junk(i), "xx") for i in range(120)] + [(3000 + i, junk(3), "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    judged = qr.quality_rules(docs).where("not base_failed").cache()
    share = {r.kind: r.share for r in judged.groupBy((F.floor(F.col("row.doc_id") / 1000)).alias("kind")).agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[0] > 0.9 and share[1] == 0 and share[2] > 0.9 and share[3] == 0
    counts = {r.language: r for r in qr.rejections(judged).collect()}
    assert counts["en"].rejected >= 300 and counts["en"].chars_per_token >= 300 and counts["en"].texts == judged.where("language = 'en'").count()


def test_measured_bands_reject_labelled_junk(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = qr.quality_rules(docs).where("not base_failed").select("row.doc_id", "kept")
    kept = {r.quality: r.share for r in judged.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[0] < 0.5 and kept[1] > 0.9
