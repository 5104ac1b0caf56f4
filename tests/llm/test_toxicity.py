import itertools
import os
import random

import numpy as np
import pytest

import __spark_entry__ as registry
from ledgerloom.llm import text as text_module, toxicity as tx
from ledgerloom.llm.text import labelled_sample

LARGE = "/root/testdata/check_h"


def by_hand(left, right):
    """The kernel as a sum over all pairs of equal subsequences."""
    total = 0.0
    for a in itertools.combinations(range(len(left)), tx.ORDER):
        for b in itertools.combinations(range(len(right)), tx.ORDER):
            if [left[i] for i in a] == [right[j] for j in b]:
                total += tx.LAMBDA ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_kernel_by_hand():
    rng = random.Random(2)
    units = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(40)] + ["abcd", "aaaaaaaa", "ab"]
    marks = ["^abcab", "aaaa", "bcéab", "abc"]
    got = tx.kernel(units, marks)
    for i, u in enumerate(units):
        for j, m in enumerate(marks):
            scale = by_hand(u, u) * by_hand(m, m)
            assert got[i, j] == pytest.approx(by_hand(u, m) / scale**0.5 if scale else 0.0, abs=1e-4)


def test_words_and_windows():
    assert tx.raw_words("You I d i o t now, A b") == ["you", "i", "d", "i", "o", "t", "now,", "a", "b", "idiot"]
    assert tx.windows("ab") == [] and tx.windows("abc") == ["^abc"]
    long = "abcdefghijklmnop"
    assert set("".join(tx.windows(long))) == set("^" + long) and tx.windows(long)[0] == "^abcdefgh"
    assert tx.stripped("i-d.i_o*t!") == "idiot"


def sample(insult="grobian", count=60):
    rng = random.Random(1)
    syllables = ["ta", "mo", "li", "ven", "ku", "sar", "pe", "do", "rin", "al"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    clean = [". ".join(" ".join(word() for _ in range(8)) for _ in range(6)) for _ in range(count)]
    toxic = [f"{' '.join(word() for _ in range(9))} you {insult} {word()}. {' '.join(word() for _ in range(9))}" for _ in range(count)]
    return clean, toxic


def test_gapped_and_inserted_insults():
    clean, toxic = sample()
    machine = tx.fit(clean + toxic, np.repeat([0, 1], [len(clean), len(toxic)]))
    score = lambda texts: tx.Scorer(machine).score(texts)
    fresh_clean, fresh_toxic = sample(count=120)
    assert (score(fresh_clean[60:]) < 0.7).all() and (score(fresh_toxic[60:]) >= 0.7).all()
    assert (score(["ta mo gr-ob-ian", "li g r o b i a n ven", "grobxian", "GROBIAN!!", "groobian", "kumo " * 3000 + "grobian"]) >= 0.7).all()
    assert (score(["", "ta", "kumo " * 3000, "g r"]) < 0.7).all()


def test_memory_of_words_changes_nothing(monkeypatch):
    clean, toxic = sample()
    machine = tx.fit(clean + toxic, np.repeat([0, 1], [len(clean), len(toxic)]))
    whole = tx.Scorer(machine).score(clean + toxic)
    monkeypatch.setattr(tx, "MEMO_BYTES", 2)
    monkeypatch.setattr(tx, "MEMO_WINDOWS", 2)
    forgetful = tx.Scorer(machine)
    assert np.allclose(whole, np.concatenate([forgetful.score([t]) for t in clean + toxic]))


def insults(count, rng):
    return ["".join(rng.choice("bcdfgklmnprstvz") + rng.choice("aeiou") for _ in range(4)) for _ in range(count)]


def test_many_insults_are_all_found():
    rng = random.Random(7)
    words, clean_words = insults(100, rng), insults(2000, rng)
    line = lambda *more: " ".join(sorted([*rng.sample(clean_words, 9), *more], key=lambda w: rng.random()))
    toxic, clean = [line(w) for w in words for _ in range(12)], [line() for _ in range(1500)]
    machine = tx.fit(toxic + clean, np.repeat([1, 0], [len(toxic), len(clean)]))
    assert (tx.Scorer(machine).score([line(w) for w in words]) >= tx.THRESHOLD).sum() >= 95
    assert (tx.Scorer(machine).score([line() for _ in range(500)]) >= tx.THRESHOLD).mean() <= 0.02


def test_words_that_share_a_stem_with_insults_stay_clean():
    """The bias may end above the cut; texts score by their own windows all the same."""
    rng = random.Random(3)
    stems = insults(60, rng)
    toxic = [f"{rng.choice(stems)}rux {rng.choice('pq')}ol" for _ in range(600)]
    clean = [" ".join(rng.choice(stems)[:4] + rng.choice(["mi", "sta", "lo"]) for _ in range(4)) for _ in range(1500)]
    machine = tx.fit(toxic + clean, np.repeat([1, 0], [600, 1500]))
    assert (tx.Scorer(machine).score(clean) >= tx.THRESHOLD).mean() <= 0.02
    assert tx.Scorer(machine).score(["", "a b", "?!"]).max() < 1e-6


def test_scorer_makes_the_decisions_of_the_machine():
    clean, toxic = sample()
    machine = tx.fit(clean + toxic, np.repeat([0, 1], [len(clean), len(toxic)]))
    for text, decision in zip(clean + toxic, tx.Scorer(machine).decide(clean + toxic)):
        units = [x for w in tx.raw_words(text) for x in tx.windows(tx.stripped(w))]
        assert decision == pytest.approx(machine.decisions(units).max(), abs=1e-4)


def test_landmarks_span_the_others():
    rng = random.Random(5)
    marks = ["^" + w for w in insults(40, rng)]
    marks += marks[:5]
    chosen = tx.spanning(marks)
    gram, cross = tx.kernel(chosen, chosen).astype(float), tx.kernel(marks, chosen).astype(float)
    rest = 1 - np.einsum("ij,jk,ik->i", cross, np.linalg.pinv(gram), cross)
    assert len(chosen) < len(marks) and rest.max() <= tx.COVERED + 1e-3
    assert len(tx.spanning(marks, most=7)) == 7 and tx.spanning([]) == []


def test_held_out_documents_of_the_small_table(spark):
    """Its toxic words share stems with ordinary ones in three of four languages, so recall is lower than on the larger tables."""
    folder = "/root/testdata/sf0.1"
    rows = registry.queries()["op6_toxicity"](spark, folder).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert np.mean([p for p, label in held if label == 1]) >= 0.7
    assert np.mean([p for p, label in held if label == 0]) <= 0.03


@pytest.mark.skipif(not os.path.isdir(LARGE), reason="needs the larger tables, whose toxic words are distinct")
def test_held_out_documents(spark):
    rows = registry.queries()["op6_toxicity"](spark, LARGE).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    assert len(rows) == 51_282 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert np.mean([p for p, label in held if label == 1]) >= 0.97
    assert np.mean([p for p, label in held if label == 0]) <= 0.01


def test_edge_cases(spark):
    clean, toxic = sample()
    rows = [(i, t, "x") for i, t in enumerate(clean + toxic)] + [(500, None, "x"), (500, "", "x"), (0, clean[0], "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string")
    labels = spark.createDataFrame([(i, int(i >= 60)) for i in range(120)], "doc_id bigint, toxic int")
    machine = tx.learn_toxicity(docs, labels)
    kept = tx.remove_toxic(docs, machine)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*range(60), 0, 500, 500])
    nothing = tx.learn_toxicity(docs, labels.limit(0))
    assert {r.score for r in tx.score_toxicity(docs, nothing).collect()} == {0.0}
    assert tx.toxicity_report(docs.limit(0), labels.limit(0)).count() == 0


def test_an_id_on_very_many_rows_is_sampled(spark):
    docs = spark.range(30_000).selectExpr("if(id % 2 = 0, 7, 8) as doc_id", "concat('text ', id % 9000) as text")
    labels = spark.createDataFrame([(7, 0), (8, 1), (8, 1)], "doc_id bigint, toxic int")
    sample = labelled_sample(docs, labels, "toxic", "doc_id", "text", 500, 1000).collect()
    counts = {label: sum(r.label == label for r in sample) for label in (0, 1)}
    assert all(350 <= n <= 650 for n in counts.values())
    assert len({(r["_id"], r.text) for r in sample}) == len(sample)


def test_a_dirty_column_of_groups_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(text_module, "MOST_GROUPS", 3)
    rows = spark.range(2000).selectExpr("id", "if(id < 1500, cast(id % 3 as string), concat('dirt ', id)) as lang")
    assert {r.lang for r in text_module.bounded_sample(rows, "lang", 50, "id").collect()} == {"0", "1", "2"}
