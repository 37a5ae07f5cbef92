import collections
import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lastro.llm import packing

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PATH = packing.tokenizer_path()


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(
    st.text(max_size=60),
    st.lists(st.sampled_from(["a", "The", " ", "  ", "\n", "\t", "é", "12", "!!", "'s", " ", "　", "x\n", "<|endoftext|>"]), max_size=30).map("".join),
))
def test_encoder_gives_the_ids_of_the_tokenizer(text):
    from tokenizers import Tokenizer

    text = text.encode("utf-8", "ignore").decode()
    tokenizer = Tokenizer.from_file(PATH) if not hasattr(packing, "_test_tokenizer") else packing._test_tokenizer
    packing._test_tokenizer = tokenizer
    tokenizer.encode_special_tokens = True
    assert packing.Encoder(PATH)(text) == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "The", " ", "  ", "\n", "é", "!!", "<|endoftext|>", "<|", "|>", "endoftext"]), max_size=20).map("".join))
def test_added_tokens_as_the_tokenizer_maps_them_by_default(text):
    from tokenizers import Tokenizer

    if not hasattr(packing, "_default_tokenizer"):
        packing._default_tokenizer = Tokenizer.from_file(PATH)
    assert packing.Tokenizer(PATH)(text) == packing._default_tokenizer.encode(text, add_special_tokens=False).ids


def test_packed_ids_of_a_text_with_an_added_token(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")
    (row,) = packing.pack(docs).collect()
    ids = np.array([64, 220, 50256, 275, 1], "<u4")
    assert (row.doc_tokens, row.length, row.ids_crc32) == (5, 5, zlib.crc32(ids.tobytes()))


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=64))
def test_patterns_hold_every_length_once(histogram):
    plan = packing.patterns(histogram, 64)
    placed = collections.Counter()
    for pattern, count in plan:
        assert sum(pattern) <= 64 and count > 0
        for length in pattern:
            placed[length] += count
    assert placed == collections.Counter(histogram)
    assert len(plan) <= 2 * 64


def pieces_by_sequence(rows):
    sequences = collections.defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    return sequences


def test_pieces_cover_every_document_and_sequences_have_no_gap(spark, folder, reference):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = packing.pack(docs).collect()
    by_doc = collections.defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids, at = np.array(reference(text or "") + [1], "<u4"), 0
        for row in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert row.start == at and row.doc_tokens == len(ids)
            assert row.ids_crc32 == zlib.crc32(ids[at : at + row.length].tobytes())
            at += row.length
        assert at == len(ids)
    for placed in pieces_by_sequence(rows).values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= packing.MAX_LEN
    total = sum(r.length for r in rows)
    assert total > 0.95 * packing.MAX_LEN * len(pieces_by_sequence(rows))


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (None, "", "y"), (2, "word " * 6000, None), (2, "word " * 6000, None), (3, "  \n ", "z")],
        "doc_id long, text string, length string",
    )
    rows = packing.pack(docs).collect()
    assert collections.Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0) == {
        (1, 1): 1, (None, 1): 1, (2, rows and max(r.doc_tokens for r in rows)): 2,
        (3, min(r.doc_tokens for r in rows if r.doc_id == 3)): 1,
    }
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert packing.pack(docs.limit(0)).collect() == []


def test_many_pieces_of_one_length_are_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 7)
    docs = spark.range(300).selectExpr("id AS doc_id", "'same text' AS text")
    rows = packing.pack(docs, max_len=16).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 300
