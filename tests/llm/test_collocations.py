import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import collocations as c
from ledgerloom.llm.text import flat_bytes


def brute(rows, least, order=5, top=2000):
    """Counts of all phrases of each language by slices, then the definition."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, order + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i:i + k])] += 1
    found = []
    for lang, f in counts.items():
        scored = []
        often = {p: x for p, x in f.items() if len(p) > 1 and x >= least}
        for p, a in often.items():
            inside = (q for q in often if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))))
            if any(100 * often[q] >= 100 * a for q in inside):
                continue
            score, _, l, r = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(found)


def found(frame, **options):
    return sorted(tuple(r) for r in c.collocations(frame, **options).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = ["the", "Of", "in", "état", "naïve", "日本", "x" * 300, "-", " ", "a\x00b"]
    rows = []
    for i in range(400):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", " ", ", ", "\n", "."]) for _ in range(rng.randint(0, 60)))
        text += rng.choice(["", " New York City hall ", " new york city HALL is", " von der Stadt"]) * rng.randint(0, 2)
        rows.append((text, rng.choice(["en", "en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), (" \t. ,", "fr"), ("lonely words here", "es")] + [rows[0]] * 3


@pytest.mark.parametrize("least,top", [(20, 2000), (5, 7), (100, 2000)])
def test_against_brute_force(spark, rows, least, top):
    frame = spark.createDataFrame([(t, l, 1, "x") for t, l in rows], "text string, lang string, n int, word string").repartition(6)
    wanted = brute(rows, least, top=top)
    assert found(frame, least=least, top=top) == wanted
    assert wanted


def test_other_orders_and_repeats(spark):
    rows = [("a a a a a a b a a", "x")] * 9 + [("b a. b a", "x")] * 4
    frame = spark.createDataFrame(rows, "text string, lang string")
    for order in (2, 3, 5):
        assert found(frame, least=3, order=order) == brute(rows, 3, order)


def test_languages_named_like_words(spark):
    rows = [("en es en es", "es")] * 5 + [("es en. es en", "en")] * 5
    assert found(spark.createDataFrame(rows, "text string, lang string"), least=3) == brute(rows, 3)


def test_products_beyond_64_bits(spark):
    phrases = spark.createDataFrame([("x", [1, 2], 4_000_000_000), ("x", [1], 4_000_000_001), ("x", [2], 5_000_000_000)], "lang string, phrase array<bigint>, f bigint")
    totals = spark.createDataFrame([("x", 9_000_000_000_007)], "lang string, n bigint")
    row = c.scored_phrases(phrases, totals).first()
    assert row["score"] == 1000 * 4_000_000_000 * 9_000_000_000_007 // (4_000_000_001 * 5_000_000_000)


def test_ties_take_the_earliest_cut_after_flooring(spark):
    phrases = [("x", [1, 2, 3], 10), ("x", [1], 20), ("x", [2, 3], 20), ("x", [1, 2], 40), ("x", [3], 10)]
    row = c.scored_phrases(spark.createDataFrame(phrases, "lang string, phrase array<bigint>, f bigint"), spark.createDataFrame([("x", 100)], "lang string, n bigint")).where("size(phrase) = 3").first()
    assert (row["score"], row["l"], row["r"]) == (2500, 20, 20)


def test_no_rows(spark):
    for rows in ([], [(None, None)], [("one two", "en")]):
        assert found(spark.createDataFrame(rows, "text string, lang string")) == []


def _one_code(words):
    return [words.lang, words.code * np.uint64(0) + np.uint64(5), words.other_hashes()]


_one_code.__module__ = "__main__"  # sent to the workers by value


def test_shared_codes_take_another_salt(spark, monkeypatch):
    """With one code for all words under the first salt, the second hash tells and the next salt is taken."""
    counting = c._counting
    monkeypatch.setattr(c, "_counting", lambda names, select, salt: counting(names, select if salt else _one_code, salt))
    words, salt = c._word_counts(spark.createDataFrame([("aa bb aa cc", "en")], "text string, lang string"))
    assert salt == 1 and sorted(r["n"] for r in words.collect()) == [1, 1, 2]


def test_a_task_emits_a_row_that_recurs_once(monkeypatch):
    """Held rows are emitted when they differ, not whenever there are many."""
    monkeypatch.setattr(c, "HELD_ROWS", 8)
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de"]), pa.array(["a b c", "a b"])], ["lang", "text"])
    counted = lambda batches: [b.to_pydict() for b in c._counting(["lang", "word", "check"], c._of_words, 0)(batches)]
    (once,) = counted([batch] * 9)
    assert Counter(once["lang"]) == {"en": 3, "de": 2} and once["n"] == [9] * 5
    unlike = [pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([f"a{i} b{i} c{i}"])], ["lang", "text"]) for i in range(9)]
    emitted = counted(unlike)
    assert len(emitted) == 3 and max(len(e["n"]) for e in emitted) <= 8 + 3 and sum(len(e["n"]) for e in emitted) == 27
    assert counted([]) == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet="aB .\t\n,é", max_size=30), min_size=1, max_size=5), st.integers(1, 6))
def test_lead_windows(texts, order):
    data, edges = flat_bytes(pa.array(texts))
    words = c.Words(data, edges, np.zeros(len(texts), np.int64), np.array([7], np.uint64), 0)
    spelt = words.spelling(np.arange(len(words.code)))
    code = {int(k): s for k, s in zip(words.code, spelt)}
    windows = Counter(tuple(code[int(x)] for x in row if x) for row in zip(*c.lead_windows(words.code, words.joined, order)))
    wanted = Counter()
    for text in texts:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text.replace("B", "b")):
            w = [x.encode() for x in re.findall("[^ \t]+", piece)]
            wanted.update(tuple(w[i:i + order]) for i in range(len(w)))
    assert windows == wanted


def test_bitmap(spark):
    codes = [0, 1, -1, 63, 64, 2**63 - 1, -(2**63), 123456789012345]
    bits = c.bitmap(spark.createDataFrame([(x,) for x in codes], "code bigint"), 8)
    assert c.is_set(bits, np.array(codes, np.int64).view(np.uint64)).all()
    assert sum(int(w).bit_count() for w in bits) == len({x % (len(bits) * 64) for x in codes})
