import hashlib
import random

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import chat


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=["<", "[", "\\", "/", "s", ">", "é", "]", "I", "N", "S", "T", "\n"], max_size=30), max_size=5))
def test_escape_is_undone_and_hides_control_strings(texts):
    raw = [t.encode() for t in texts]
    edges = np.cumsum([0, *map(len, raw)])
    data, new_edges = chat.escape(np.frombuffer(b"".join(raw), np.uint8), edges)
    for i, text in enumerate(raw):
        escaped = data[new_edges[i] : new_edges[i + 1]].tobytes()
        assert chat.unescape(escaped) == text
        assert not any(c in escaped for c in (b"<s>", b"</s>", b"[INST]", b"[/INST]"))


ROWS = [
    (1, 2, "assistant", "second </s>\n"), (1, 1, "user", "\\<[ [INST] <s>"), (1, 3, None, None), (1, None, "system", ""),
    (2, 1, "assistant", "é🙂"), (2, 1, "assistant", "a"), (2, 1, "assistant", "a"), (2, 5, "tool <s>", "x"),
    (None, 1, "user", "no id"), (3, 1, "user", ""), (4, 1, "assistant", "z" * 3000), (4, 2, "assistant", "<" * 3000), (4, 3, "user", "w"),
]


def by_hand(rows):
    found = {}
    order = lambda r: tuple((x is not None, x) for x in r[1:])
    for conv, _, role, text in sorted(rows, key=order):
        found.setdefault(conv, []).append((role or "", text or ""))
    result = []
    for conv, turns in found.items():
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        result.append((conv, len(turns), sha(whole), len(loss), sha(loss)))
    return sorted(result, key=str)


def test_against_brute_force(spark, monkeypatch):
    data = spark.createDataFrame([(*r, 1) for r in ROWS], "conv_id bigint, turn bigint, role string, text string, part int")
    assert sorted((tuple(r)[:5] for r in chat.chat_report(chat.format_chat(data)).collect()), key=str) == by_hand(ROWS)
    parts = chat.format_chat(data).collect()
    assert all(p.formatted.encode().count(chat.MIDDLE) for p in parts)


def test_a_long_conversation_comes_in_parts(spark):
    data = spark.range(40).selectExpr("7L as conv_id", "id as turn", "if(id % 2 = 1, 'assistant', 'user') as role", "repeat('ab<', 100000) as text")
    formatted = chat.format_chat(data)
    parts = formatted.orderBy("part").collect()
    assert len(parts) > 1 and len({p.part for p in parts}) == len(parts)
    said = b"".join(t for p in parts for _, t, _, _ in chat.read_turns(p.formatted.encode()))
    assert said == b"ab<" * 100_000 * 40
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert formatted.select(F.spark_partition_id().alias("t")).distinct().count() > 1  # one conversation, several tasks
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (row,) = chat.chat_report(formatted).collect()
    assert row.n_turns == 40 and row.loss_chars == 20 * 300_000


def test_a_hot_conversation_among_others(spark):
    """A third of the turns, with repeats of one turn, in the null conversation."""
    rng = random.Random(2)
    rows = [(None if i % 3 == 0 else i % 50, rng.randrange(40), rng.choice(["user", "assistant"]), rng.choice(["a<", "b", "", None])) for i in range(3000)]
    data = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    assert sorted((tuple(r)[:5] for r in chat.chat_report(chat.format_chat(data)).collect()), key=str) == by_hand(rows)


def test_no_turns(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.chat_report(chat.format_chat(empty)).count() == 0
