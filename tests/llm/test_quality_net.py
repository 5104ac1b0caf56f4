import numpy as np
import pytest

import __spark_entry__ as registry
from ledgerloom.llm import quality_net as qn

LARGE = "/root/testdata/sf0.1"


def flat(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def by_hand(net, text):
    """The network over one text, position by position."""
    blocks = (len(text) + qn.WIDTH + qn.BLOCK - 1) // qn.BLOCK
    codes = [256] * qn.WIDTH + list(text) + [256] * (blocks * qn.BLOCK - len(text))
    peaks = []
    for b in range(blocks):
        rows = [np.concatenate([net.vectors[c] for c in codes[p : p + qn.WIDTH]]) @ net.filters for p in range(b * qn.BLOCK, (b + 1) * qn.BLOCK, qn.STRIDE)]
        peaks.append(np.max(rows, axis=0))
    chunks = [np.maximum(np.maximum(peaks[i], peaks[min(i + 1, blocks - 1)]) + net.bias, 0) for i in range(blocks)]
    pooled = np.concatenate((np.max(chunks, axis=0), np.mean(chunks, axis=0), [np.log1p(len(text)) / 4]))
    logit = np.maximum(pooled @ net.inner + net.inner_bias, 0) @ net.out + net.base[0]
    return 1 / (1 + np.exp(-logit))


TEXTS = [b"", b"a", b"hello world" * 60, "é東".encode() * 200, b"#$%" * 99, bytes(range(256)) * 3]


def test_scores_by_hand():
    net = qn.ByteNet(3)
    got = net.score(*flat(TEXTS))
    assert got == pytest.approx([by_hand(net, t) for t in TEXTS], abs=1e-4)


def test_gradient_by_differences():
    net, labels = qn.ByteNet(5), np.array([0, 1, 1, 0, 1, 0], np.float32)
    rng = np.random.default_rng(0)
    for name, weight in net.weights().items():
        setattr(net, name, weight.astype(np.float64))
    net.bias += rng.uniform(0.01, 0.1, net.bias.shape)  # away from the kink at an empty place
    net.inner_bias += rng.uniform(0.01, 0.1, net.inner_bias.shape)
    grad = net.gradient(*flat(TEXTS), labels)

    def loss():
        p = np.array([by_hand(net, t) for t in TEXTS])
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for name, weight in net.weights().items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in weight.shape)
            if name == "vectors" and at[0] == 256:
                continue
            kept = weight[at]
            step = 1e-5
            weight[at] = kept + step
            up = loss()
            weight[at] = kept - step
            down = loss()
            weight[at] = kept
            assert grad[name][at] == pytest.approx((up - down) / (2 * step), abs=2e-4), name


def test_held_out_quality(spark):
    rows = registry.queries()["op5_quality"](spark, LARGE).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    good = np.array([r.score for r in held if labels[r.doc_id] == 1])
    bad = np.array([r.score for r in held if labels[r.doc_id] == 0])
    assert (good[:, None] > bad[None, :]).mean() >= 0.97
    assert (good >= 0.7).mean() >= 0.95 and (bad < 0.7).mean() >= 0.85


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 9), (1, "", 9), (2, "some words here", 9), (2, "some words here", 9), (3, "###$$$", 9)], "doc_id bigint, text string, score int")
    labels = spark.createDataFrame([(2, 1, None), (3, 0, 1), (7, None, 1)], "doc_id bigint, quality int, score int")
    net = qn.learn_quality(docs, labels)
    assert net.constant is None
    got = qn.score_quality(docs, net).select("row.doc_id", "row.score", "score").collect()
    assert len(got) == 5 and all(r[1] == 9 for r in got)
    one_kind = qn.learn_quality(docs, labels.where("quality = 1"))
    assert one_kind.constant == 1.0
    none = qn.learn_quality(docs, labels.limit(0))
    assert none.constant == 0.5 and {r.score for r in qn.score_quality(docs, none).collect()} == {0.5}
    assert qn.quality_report(docs.limit(0), labels.limit(0)).count() == 0


def test_a_long_text_is_taken_whole():
    net = qn.ByteNet(1)
    clean, junk = b"plain words and more " * 30_000, b"#$%&|<>*" * 100
    assert net.score(*flat([clean]))[0] != net.score(*flat([clean + junk]))[0]
