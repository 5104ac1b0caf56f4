import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm.simhash import covering_masks, fingerprints, linked_fingerprints, simhash_report
from ledgerloom.llm.text import flat_bytes


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    shingles = [words[i:i + 3] for i in range(len(words) - 2)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """Smallest id of each row's component, from all pairs."""
    prints = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2:
            label[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [(doc, f"{prints[i]:016x}", least.get(root(i))) for i, (doc, _) in enumerate(rows)]


def computed(texts):
    return fingerprints(*flat_bytes(pa.array(texts, pa.string()))).tolist()


def test_every_pair_of_bits_is_left_out_by_some_mask():
    masks = covering_masks()
    assert len(masks) == 7
    for i, j in itertools.combinations_with_replacement(range(64), 2):
        assert any(not m >> i & 1 and not m >> j & 1 for m in masks)
    assert all(36 <= m.bit_count() <= 37 for m in masks)
    assert all(any(all(not m >> b & 1 for b in some) for m in covering_masks(3)) for some in itertools.combinations(range(64), 3))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abC \t\n\x0b\x1c é\U0001F600Z", max_size=60)), max_size=8))
def test_fingerprints_of_any_text(texts):
    assert computed(texts) == [brute_fingerprint(t) for t in texts]


def test_fingerprints_across_blocks():
    rng = random.Random(2)
    long_text = " ".join(rng.choice("the Of and zu longerwordthanthirtytwobytesinall É".split()) for _ in range(150_000))
    texts = ["a b c d", long_text, "", "one", "two words", "x" * 3_000_000]
    assert computed(texts) == [brute_fingerprint(t) for t in texts]


def test_spark_hash_agrees(value_of):
    text = "un été long"
    assert value_of(F.xxhash64(F.lit(text))) & (2**64 - 1) == xxhash.xxh64_intdigest(text.encode(), 42) == brute_fingerprint(text)


def test_links_connect_all_pairs_within_the_radius(spark):
    rng = random.Random(4)
    found = set()
    for _ in range(40):  # clusters around centres, chains, and a dense ball
        centre = rng.getrandbits(64)
        for _ in range(30):
            point = centre
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                point ^= 1 << bit
            found.add(point)
        for step in range(6):
            centre ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            found.add(centre)
    found |= {1 << i for i in range(64)} | {0, 2**64 - 1}
    signed = [(int(np.uint64(f).astype(np.int64)),) for f in found]
    links = linked_fingerprints(spark.createDataFrame(signed, "fingerprint bigint")).collect()
    assert all((r["a"] ^ r["b"]) != 0 and ((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 2 for r in links)

    def classes(pairs):
        label = {f: f for f in found}

        def root(x):
            while label[x] != x:
                x = label[x]
            return x

        for a, b in pairs:
            label[root(a)] = root(b)
        groups = {}
        for f in found:
            groups.setdefault(root(f), set()).add(f)
        return {frozenset(g) for g in groups.values()}

    mask = 2**64 - 1
    wanted = classes((a, b) for a, b in itertools.combinations(found, 2) if (a ^ b).bit_count() <= 2)
    assert classes((r["a"] & mask, r["b"] & mask) for r in links) == wanted


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(12):
        text = [rng.choice(words) for _ in range(200)]
        for copy in range(6):
            changed = list(text)
            for _ in range(copy // 2):
                changed[rng.randrange(len(changed))] = rng.choice(words)
            rows.append((base * 10 + copy, " ".join(changed)))
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "Same Words"), (504, "same\nwords"), (505, "alone"), (503, "Same Words"), (None, "nobody owns this text"), (None, "alone")]
    rng.shuffle(rows)
    return rows


def test_report_against_all_pairs(spark, rows):
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, fingerprint int, least string").repartition(7)
    report = simhash_report(frame)
    assert report.columns == ["doc_id", "fingerprint", "component_id"]
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in report.collect()), key=order) == sorted(brute_components(rows), key=order)


def test_empty_texts_and_tables(spark):
    """Empty texts and null ones are one component; a text that nobody shares stays alone."""
    frame = spark.createDataFrame([(3, None), (1, ""), (2, "a b c")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["component_id"] for r in simhash_report(frame).collect()} == {3: 1, 1: 1, 2: 2}
    assert simhash_report(frame.limit(0)).collect() == []
