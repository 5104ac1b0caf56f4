import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import regex

import __spark_entry__ as registry
from ledgerloom.llm import near_dup as nd
from ledgerloom.llm.text import flat_bytes

MIDDLE = "/root/testdata/sf0.01"
WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def jaccard(a, b):
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


def classes_by_hand(texts, threshold=0.8):
    """Class of each text, by comparing all pairs that share a shingle."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    by_shingle = defaultdict(list)
    for i, s in enumerate(sets):
        seen = set()
        for g in s:
            for j in by_shingle[g]:
                if j not in seen:
                    seen.add(j)
                    if jaccard(s, sets[j]) >= threshold - 1e-9:
                        parent[max(root(i), root(j))] = min(root(i), root(j))
            by_shingle[g].append(i)
    return [root(i) for i in range(len(texts))]


def sets_of(texts):
    return nd.shingle_elements(*flat_bytes(pa.array(texts, pa.string())))


def test_elements_are_those_of_the_text():
    texts = ["", None, "a b", "A, b!", "a b c d e", "a b c d e a b c d e a b c d e f", "x " * 9, "é é É"]
    elements, offsets = sets_of(texts)
    sizes = np.diff(offsets)
    assert sizes.tolist() == [sum(shingles(t).values()) for t in texts]
    for i in range(len(texts)):
        own = elements[offsets[i] : offsets[i + 1]]
        assert len(set(own.tolist())) == len(own)
        for j in range(len(texts)):
            theirs = elements[offsets[j] : offsets[j + 1]]
            assert len(np.intersect1d(own, theirs)) == sum((shingles(texts[i]) & shingles(texts[j])).values())
    ids = nd.node_ids(elements, offsets)
    assert ids[2] == ids[3] and len(set(ids.tolist())) == 6


def test_signatures_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(1)
    pool = rng.integers(1, 1 << 62, 30_000, dtype=np.uint64)
    k = 4096
    for size, common in ((1, 1), (3, 2), (400, 360), (20_000, 18_000)):
        a, b = pool[:size], np.concatenate((pool[:common], pool[size : 2 * size - common])) if 2 * size - common <= len(pool) else pool[size - common : 2 * size - common]
        signatures = nd.dart_minhash(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), k)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert (signatures != np.iinfo(np.uint64).max).all()
        assert abs((signatures[0] == signatures[1]).mean() - true) < 0.04, (size, true)


def test_fractional_weights():
    rng = np.random.default_rng(4)
    elements = rng.integers(1, 1 << 62, 300, dtype=np.uint64)
    a, b = rng.uniform(0.05, 1, 300), rng.uniform(0.05, 1, 300)
    signatures = nd.dart_minhash(np.concatenate((elements, elements)), np.array([0, 300, 600]), 4096, np.concatenate((a, b)))
    assert abs((signatures[0] == signatures[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_contraction_finds_components(spark):
    rng = random.Random(7)
    nodes = [rng.getrandbits(62) for _ in range(400)]
    links = [(nodes[i], nodes[i + 1]) for i in range(200)] + [(rng.choice(nodes[200:]), rng.choice(nodes[200:])) for _ in range(120)]
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    labels = spark.createDataFrame([(n, n) for n in nodes], "node bigint, label bigint")
    got = nd.contract(labels, spark.createDataFrame(links, "a bigint, b bigint")).collect()
    groups, want = defaultdict(set), defaultdict(set)
    for node, label in got:
        groups[label].add(node)
    for n in nodes:
        want[root(n)].add(n)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_whole_documents_against_all_pairs(spark):
    rows = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want = classes_by_hand([r.text for r in rows])
    got = {r.doc_id: r for r in registry.queries()["op4_near_duplicates"](spark, MIDDLE).collect()}
    assert len(got) == len(rows)
    sizes = Counter(want)
    wrong = [r.doc_id for r, w in zip(rows, want) if (got[r.doc_id].class_id, got[r.doc_id].class_size) != (rows[w].doc_id, sizes[w])]
    assert wrong == []
    assert max(sizes.values()) > 1


def near_copies(rng, base, count, changes):
    """Copies of a text with some words replaced."""
    for _ in range(count):
        words = base.split()
        for _ in range(changes):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        yield " ".join(words)


def hard_documents():
    """A large group of copies, a large loose group of near copies, a passage that many texts share, chains."""
    rng = random.Random(11)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    passage, base = text(120), text(300)
    texts = [text(80)] * 150 + list(near_copies(rng, base, 150, 4))
    texts += [f"{text(60)} {passage} {text(60)}" for _ in range(150)]
    chain = text(200).split()
    for step in range(12):
        chain = chain[5:] + [f"c{step}x{i}" for i in range(5)]
        texts.append(" ".join(chain))
    return texts + [None, "", "...", "one two", "one two", "One, TWO", "one two three"]


def test_hot_groups_against_all_pairs(spark):
    texts = hard_documents()
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, node int").repartition(7)
    want = classes_by_hand(texts)
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_loose_bands_need_all_rounds(spark, monkeypatch):
    """Bands of one row put unlike texts into large buckets; classes must be the same."""
    monkeypatch.setattr(nd, "BANDS", 40)
    monkeypatch.setattr(nd, "BAND_ROWS", 1)
    monkeypatch.setattr(nd, "BLOCK_BYTES", 20_000)
    texts = hard_documents()[100:360:3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(2)
    given = docs.selectExpr("doc_id as id", "xxhash64(text) as text_hash", "text")
    elements, offsets = sets_of(texts)
    keys = nd.band_keys(nd.dart_minhash(elements, offsets, 40), 40, 1)
    ids = nd.node_ids(elements, offsets)
    nodes = spark.createDataFrame(list({int(n): (int(n), k.tolist()) for n, k in zip(ids, keys)}.values()), "node bigint, bands array<bigint>")
    label = {r.node: r.label for r in nd.duplicate_nodes(nodes, given).collect()}
    want, groups = classes_by_hand(texts), defaultdict(set)
    for i, n in enumerate(ids.tolist()):
        groups[label.get(n, n)].add(i)
    expected = defaultdict(set)
    for i, w in enumerate(want):
        expected[w].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_blocks_give_the_links_of_all_pairs():
    texts = hard_documents()[120:420:4]
    elements, offsets = sets_of(texts)
    nodes = [{"node": i, "label": i // 3, "elements": np.sort(elements[offsets[i]:offsets[i + 1]]).tobytes()} for i in range(len(texts))]
    own, got = nodes[::2], nd.links_between(nodes[::2], nodes, nd.SIMILARITY)
    wanted = {(x["node"], y["label"]) for x in own for y in nodes if x["label"] != y["label"] and nd.similar(x["elements"], y["elements"], nd.SIMILARITY)}
    ends = {(i, nodes[j]["label"]) for a, b in got for i, j in ((a, b), (b, a)) if (i, nodes[j]["label"]) in wanted}
    assert ends >= {(i, label) for i, label in wanted} and len(got) <= len(wanted)
    assert all(nd.similar(nodes[a]["elements"], nodes[b]["elements"], nd.SIMILARITY) for a, b in got)


def test_short_signatures_pass_all_similar_pairs():
    texts = hard_documents()[150:450:3]
    elements, offsets = sets_of(texts)
    shorts = [x.tobytes() for x in (nd.mix64(nd.dart_minhash(elements, offsets)) & np.uint64(0xFF)).astype(np.uint8)]
    labels = [i // 2 for i in range(len(texts))]
    got = set(nd.close_pairs(list(range(len(texts))), labels, shorts))
    sets = [np.sort(elements[offsets[i]:offsets[i + 1]]).tobytes() for i in range(len(texts))]
    wanted = {(i, j) for i in range(len(texts)) for j in range(i) if labels[i] != labels[j] and nd.similar(sets[i], sets[j], nd.SIMILARITY)}
    assert wanted <= got and len(wanted) > 50
    apart = {(i, j) for i in range(len(texts)) for j in range(i) if labels[i] != labels[j] and not nd.similar(sets[i], sets[j], 0.5)}
    assert not apart & got


@pytest.mark.parametrize("few", [0, 1000])
def test_small_and_large_buckets_give_the_same_classes(spark, monkeypatch, few):
    monkeypatch.setattr(nd, "FEW_NODES", few)
    texts = hard_documents()[::3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == classes_by_hand(texts)


def test_keep_one_with_clashing_columns(spark):
    rows = [(1, "a b c d e f", 11, "g", 5, "n"), (1, "a b c d e f", 11, "g", 5, "n"), (2, "A b c d e f", 12, None, 6, "m"), (3, "", 13, "h", 7, "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _text_hash bigint, _id string, _first int, row string")
    kept = nd.keep_one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[3]]
    renamed = docs.withColumnsRenamed({"_text_hash": "id", "_id": "text_hash"})
    assert sorted(map(tuple, nd.keep_one_per_class(renamed).collect())) == [rows[0], rows[3]]


def test_a_long_list_of_gone_documents(spark, monkeypatch):
    """With the list too long to be sent a bitmap parts the rows; the result is the same."""
    texts = hard_documents()[::2]
    docs = spark.createDataFrame([(i % 400, t, "x") for i, t in enumerate(texts + texts[:20])], "doc_id bigint, text string, code string").repartition(3)
    sent = sorted(map(str, nd.keep_one_per_class(docs).collect()))
    monkeypatch.setattr(nd, "SENT_PAIRS", 0)
    assert sorted(map(str, nd.keep_one_per_class(docs).collect())) == sent and 0 < len(sent) < docs.count()


def test_keep_one(spark):
    rows = [(3, "a b c d e f", "x", 1), (1, "A b c d e f!", "y", 2), (1, "A b c d e f!", "y", 2), (2, None, "z", 3), (2, None, "z", 3), (5, "", None, 4), (None, "q", "n", 5), (1, "other text here", "m", 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, class_id int")
    kept = nd.keep_one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.class_id) for r in kept.collect()) == [("1", 2), ("1", 6), ("2", 3), ("2", 3), ("5", 4), ("None", 5)]
    assert nd.keep_one_per_class(docs.limit(0)).count() == 0
    assert nd.near_duplicates(docs.limit(0)).count() == 0


def test_small_steps_are_written_by_few_tasks(spark, monkeypatch):
    """Each of them used to be written by all tasks of its shuffle, most without a row or with a few."""
    wrote, plain = [], nd.settled

    def noted(df, *most):
        kept = plain(df, *most)
        wrote.append((kept.columns, len(kept.inputFiles())))
        return kept

    monkeypatch.setattr(nd, "settled", noted)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(60)]
    texts += [f"{t} more" for t in texts[:40]] + texts[:20]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        kept = nd.keep_one_per_class(docs).select("doc_id").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r.doc_id for r in kept) == list(range(60))
    for columns in (["a", "b"], ["label", "to"], ["node", "label"], ["node", "first", "class_size"], ["id", "text_hash", "gone"]):
        assert any(c == columns and n == 1 for c, n in wrote), columns
    assert sum(n > 8 for _, n in wrote) <= 3, wrote
