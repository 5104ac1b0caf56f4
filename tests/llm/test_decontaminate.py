import random

import numpy as np
import regex

from ledgerloom.llm import decontaminate as dc

WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(text, items, window=13):
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        theirs = words(item_text)
        size = min(window, len(theirs))
        wanted = {tuple(theirs[i : i + size]) for i in range(len(theirs) - size + 1)} if size else set()
        for i in range(len(own) - size + 1) if size else ():
            if tuple(own[i : i + size]) in wanted:
                hit.update(range(i, i + size))
                found.add(str(item))
    return len(own), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(own)


def test_suffix_array_is_sorted_and_complete():
    rng = np.random.default_rng(3)
    for size in (0, 1, 50, 400):
        given = rng.integers(0, 4, size).astype(np.int32)
        padded = np.concatenate((given, np.zeros(13, np.int32)))
        order = dc.suffix_array(padded, 13)
        assert sorted(order.tolist()) == np.flatnonzero(given).tolist()

        def key(p):
            run = padded[p : p + 13].tolist()
            return run[: run.index(0)] if 0 in run else run

        keys = [key(p) for p in order]
        assert keys == sorted(keys)


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["a", "b", "Über", "c3", "東京"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 5, 13, 14, 30])))) for i in range(12)]
    items += [(3, "z z"), (None, "q r s"), (99, None), (100, "!!")]
    docs = [(i, " ".join(rng.choice(vocabulary[:4]) for _ in range(rng.choice([0, 1, 3, 20, 300])))) for i in range(40)]
    for i in range(20):
        filler = " ".join(f"w{k}" for k in range(rng.choice([5, 200, 900])))
        docs.append((100 + i, f"{filler}. {items[i % 12][1].upper()}! {filler}"))
    docs += [(200, None), (200, "q-R_s Z, z"), (200, "q-R_s Z, z"), (None, "東京"), (7, "a" * 100_000)]
    given = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id bigint, text string, row string, n_hit int")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted((str(d), *map(str, by_hand(t, [("null" if i is None else i, x) for i, x in items]))) for d, t in docs)
    for block in (dc.BLOCK_BYTES, 30):  # one pass, and many
        got = dc.contamination(given, bench, block_bytes=block).select("row.doc_id", "n_words", "n_hit", "items", "contaminated").collect()
        assert sorted(tuple(map(str, r)) for r in got) == want


def test_filter_keeps_columns_and_clean_rows(spark):
    docs = spark.createDataFrame([(1, "one two", "k"), (2, "three", "l"), (3, None, "m")], "doc_id int, text string, items string")
    bench = spark.createDataFrame([(1, "TWO")], "item_id int, text string")
    kept = dc.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert dc.remove_contaminated(docs, bench.limit(0)).count() == 3
    assert dc.remove_contaminated(docs.limit(0), bench).count() == 0


def matches_by_hand(text, items, window=13):
    """All common runs of words that cannot be made longer at either end."""
    own, found = words(text), []
    for item, item_text in items:
        theirs = words(item_text)
        least = min(window, len(theirs))
        for i in range(len(own)):
            for j in range(len(theirs)):
                if own[i] != theirs[j] or (i and j and own[i - 1] == theirs[j - 1]):
                    continue
                n = 0
                while i + n < len(own) and j + n < len(theirs) and own[i + n] == theirs[j + n]:
                    n += 1
                if n >= least:
                    found.append((i, str(item), j, n))
    return sorted(found)


def test_longest_matches_against_brute_force(spark):
    rng = random.Random(8)
    vocabulary = ["a", "b", "Über", "c3"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 13, 14, 40])))) for i in range(8)] + [(20, ""), (21, None)]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(60)) + " x " + items[i % 8][1] + " " + items[-3][1]) for i in range(25)] + [(90, None), (91, "!")]
    frame = spark.createDataFrame([(i, t, "q") for i, t in docs], "doc_id bigint, text string, words string").repartition(4)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (dc.BLOCK_BYTES, 60):
        got = {}
        for r in dc.benchmark_matches(frame, benchmark, window=5, block_bytes=block).collect():
            assert r.row.asDict().keys() == {"doc_id", "words"}
            got.setdefault(r.row.doc_id, []).append((r.word, r.item, r.item_word, r.words))
        assert {d: sorted(m) for d, m in got.items()} == {i: m for i, t in docs if (m := matches_by_hand(t, items, 5))}


def test_one_pass_of_python_per_block(spark):
    items = [(i, f"only here {i} " + " ".join(f"w{i}x{j}" for j in range(15))) for i in range(6)]
    docs = spark.createDataFrame([(i, t) for i, t in items] + [(50, "none")], "doc_id bigint, text string")
    found = dc.contamination(docs, spark.createDataFrame(items, "item_id bigint, text string"), block_bytes=60)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.row.doc_id, r.items, r.contaminated) for r in found.collect()) == [(i, [str(i)], True) for i in range(6)] + [(50, [], False)]
