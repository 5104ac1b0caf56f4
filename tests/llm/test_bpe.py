import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import __spark_entry__ as registry
from ledgerloom.llm import bpe

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.default_vocabulary())


CASES = [
    "", " ", "\n\n  x", "aaaa aaaaa aaaaaaa", "don't we'll I'M 'll", "naïve façade 東京 привет 12345 ½ ²", "a<|endoftext|>b <|endoftext|>",
    "\x00\x1c\x85  ​　 end", "x" * 5000, "0123456789" * 500, "🙂🙃" * 50, "tab\tand  two  spaces   ", "ñññ ééé é", "   ﻿\x0b\x0c",
]


def same_as_library(library, vocabulary, texts):
    ids, edges = bpe.Encoder(vocabulary).encode(texts)
    for i, text in enumerate(texts):
        got = ids[edges[i] : edges[i + 1]].tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, text[:80]
        assert bpe.decode(vocabulary, np.array(got, np.int32), np.array([0, len(got)])) == [library.decode(got, skip_special_tokens=False)]


def test_ids_and_texts_are_those_of_the_library(library, vocabulary):
    same_as_library(library, vocabulary, CASES)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=60), max_size=5))
def test_any_text(library, vocabulary, texts):
    same_as_library(library, vocabulary, texts)


def test_forgetting_words_changes_nothing(library, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_BYTES", 3)
    encoder = bpe.Encoder(vocabulary)
    for text in CASES * 2:
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_ids_that_are_no_text(library, vocabulary):
    lonely = [int(vocabulary.of_byte[0xE2]), int(vocabulary.of_byte[0x41])]
    assert bpe.decode(vocabulary, np.array(lonely), np.array([0, 2])) == [library.decode(lonely, skip_special_tokens=False)]


def test_whole_documents(spark, library):
    got = {r.doc_id: r for r in registry.queries()["op3_bpe"](spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for row in rows:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert got[row.doc_id].n_tokens == len(ids)
        assert got[row.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[row.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_nulls_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, "a b", 6), (1, "a b", 6), (None, "", 7)], "doc_id bigint, text string, ids int")
    got = bpe.bpe_round_trip(docs).select("row.ids", "n_tokens", "decoded").collect()
    assert sorted(map(tuple, got)) == [(5, 0, ""), (6, 2, "a b"), (6, 2, "a b"), (7, 0, "")]
    assert bpe.bpe_round_trip(docs.limit(0)).count() == 0
