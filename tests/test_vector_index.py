import random

import numpy as np
import pytest

from ledgerloom.operators import vector_index as vi
from ledgerloom.session import shared_dir


def made(count=600, size=8, groups=12):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(groups, size)) * 3
    vectors = (centres[rng.integers(0, groups, count)] + rng.normal(size=(count, size))).astype(np.float32)
    return [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]


def nearest(rows, asked, k):
    ids, matrix = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    out = {}
    for name, v in asked:
        v = np.array(v, np.float64)
        near = np.round(matrix @ v / np.linalg.norm(v), vi.DIGITS)
        out[name] = [int(ids[i]) for i in np.lexsort((ids, -near))[:k]]
    return out


def answers(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r.vec_id)
        assert r.rank == len(out[r.query_id])
    return out


@pytest.fixture(scope="module")
def rows():
    found = made()
    hot = found[5][1]
    return found + [(1000 + i, hot) for i in range(300)] + [(7, found[7][1])]  # a third of the rows is one vector; a repeated row


ODD = [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [float("nan")] + [1.0] * 7), (2004, [1.0, 2.0]), (2005, [None] + [1.0] * 7), (2006, [float("inf")] * 8)]


@pytest.fixture(scope="module")
def index(spark, rows):
    mixed = rows + ODD
    random.Random(1).shuffle(mixed)
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in mixed], "vec_id bigint, embedding array<float>, id string, list int").repartition(5)
    return vi.build_index(frame, shared_dir(spark, "index"), lists=24)


def test_every_row_is_in_one_list(spark, rows, index):
    held = index.blocks.selectExpr("list", "inline(items)").collect()
    assert sorted(r.id for r in held) == sorted([i for i, _ in rows] + [i for i, _ in ODD])
    assert {r.id for r in held if r.list == vi.NO_LIST} == {i for i, _ in ODD}
    lists = {}
    for r in held:
        lists.setdefault(tuple(r.vector or ()) if r.list != vi.NO_LIST else r.id, set()).add(r.list)
    assert all(len(found) == 1 for found in lists.values()) and len({r.list for r in held}) > 12


def test_all_lists_give_the_exact_answer(spark, rows, index):
    asked = rows[::37] + [(-1, rows[5][1])]
    queries = spark.createDataFrame([*asked, (-2, None), (-3, [0.0] * 8)], "query_id bigint, embedding array<float>")
    assert answers(vi.search(index, queries, 10, len(index.centres))) == nearest(rows, asked, 10)
    few = vi.search(index, queries, 5000, len(index.centres))  # more than there are
    assert few.groupBy("query_id").count().where("count <> 901").count() == 0


def test_recall_and_pruned_lists(spark, rows, index):
    asked = [r for r in made(900) if r[0] >= 600]
    queries = spark.createDataFrame(asked, "query_id bigint, embedding array<float>")
    found, exact = vi.search(index, queries, 10, 6), vi.search(index, queries, 10, len(index.centres))
    by_hand = nearest(rows, asked, 10)
    assert answers(exact) == by_hand
    got = answers(found)
    share = np.mean([len(set(got[q]) & set(by_hand[q])) / 10 for q in by_hand])
    row = vi.recall(found, exact).first()
    assert row.queries == 300 and row.recall == pytest.approx(share) and share >= 0.95


def test_blocks_are_bounded(spark, rows, monkeypatch):
    monkeypatch.setattr(vi, "BLOCK_ROWS", 40)
    index = vi.build_index(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), shared_dir(spark, "index"), lists=4)
    sizes = [r[0] for r in index.blocks.selectExpr("size(items)").collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 80
    queries = spark.createDataFrame(rows[:40], "query_id bigint, embedding array<float>")
    assert answers(vi.search(index, queries, 3, 4)) == nearest(rows, rows[:40], 3)


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(vi, "SAMPLE_PER_LIST", 4)
    frame = spark.createDataFrame(made(500), "vec_id bigint, embedding array<float>")
    assert len(vi.fit_centres(frame, "embedding", 10)) <= 10


def test_small_tables(spark):
    schema = "vec_id bigint, embedding array<float>"
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, embedding array<float>")
    for rows, wanted in (([], {}), ([(1, None)], {}), ([(4, [2.0, 1.0])], {1: [4]}), ([(4, [2.0, 1.0])] * 9, {1: [4] * 2})):
        index = vi.build_index(spark.createDataFrame(rows, schema), shared_dir(spark, "index"))
        assert answers(vi.search(index, asked, 2, 3)) == wanted
