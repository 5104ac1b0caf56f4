import numpy as np
import pytest

import __spark_entry__ as registry
from ledgerloom.llm import language as lg

MIDDLE = "/root/testdata/sf0.01"


def test_bundles_by_hand():
    texts = ["Abc, abc!", "", "12 -- 3", "é東 x" * 40, "Straße İz"]
    got, any_letter = lg.bundle(texts, 96)
    for text, vector, letter in zip(texts, got, any_letter):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        padded = " " + " ".join(words) + (" " if words else "")
        want = np.zeros(96)
        for i in range(len(padded) - 2):
            a, b, c = lg.symbol_vectors(np.array([ord(x) for x in padded[i : i + 3]]), 96).astype(int)
            want += np.roll(a, 2) * np.roll(b, 1) * c
        assert letter == bool(words)
        assert np.allclose(vector, want)


def test_held_out_accuracy_on_whole_documents(spark):
    rows = registry.queries()["op1_language"](spark, MIDDLE).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert 0.2 < len(held) / len(rows) < 0.3
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, "le chat et la souris", "fr", 1), (1, "le chat et la souris", "fr", 1), (4, "the cat and the mouse", "en", 2), (5, None, "en", 3), (None, "", None, 4), (7, "123 !", "fr", 5),
         (8, "the mouse and the dog", None, 6)],
        "doc_id bigint, text string, lang string, score int",
    )
    names, prototypes = lg.learn_prototypes(docs)
    assert names == ["en", "fr"] and np.allclose(np.linalg.norm(prototypes, axis=1), 1)
    got = sorted((r.row.score, r.lang_pred) for r in lg.predict_language(docs, names, prototypes).collect())
    assert got == [(1, "fr"), (1, "fr"), (2, "en"), (3, "und"), (4, "und"), (5, "und"), (6, "en")]
    none, nothing = lg.learn_prototypes(docs.limit(0))
    assert none == [] and {r.lang_pred for r in lg.predict_language(docs, none, nothing).collect()} == {"und"}
    assert lg.language_report(docs.limit(0)).count() == 0


def test_long_text_is_taken_whole():
    head, tail = "the cat and the mouse " * 2000, "le chat et la souris " * 20000
    whole = lg.bundle([head + tail], 256)[0]
    parts = lg.bundle([head, tail], 256)[0].sum(axis=0)
    assert np.corrcoef(whole[0], parts)[0, 1] == pytest.approx(1, abs=1e-3)
