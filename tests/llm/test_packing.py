"""Pieces against the tokenizer applied to whole texts, and the packing rules."""

import zlib

import numpy as np
import pyarrow.parquet
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kerbside.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
FILES = (PATH, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
ENCODER = packing.Encoder(*FILES)


def plain_ids(text):
    return PLAIN.encode(text, add_special_tokens=False).ids


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "The", "it's", "'s", "é", "ñandú", "²", "1234", "!!", ",", ".", "_", " ", "\x1c",
                                 "<|endoftext|>", "漢字", "é", "🙂", "Ω", "-", "x.y", "'LL"]), max_size=25).map("".join))
def test_cached_encoding_equals_plain_encoding(text):
    for _ in range(2):  # the second time from the cache
        assert np.frombuffer(ENCODER.ids(text), "<u4").tolist() == plain_ids(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text_is_encoded_alike(text):
    assert np.frombuffer(ENCODER.ids(text), "<u4").tolist() == plain_ids(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([bytes([b]).decode("latin-1") for b in range(256)] + ["ab", "the ", " '"]), max_size=40).map("".join))
def test_latin_texts_are_encoded_alike(text):
    assert np.frombuffer(ENCODER.ids(text), "<u4").tolist() == plain_ids(text)


def test_documents_are_encoded_alike():
    table = pyarrow.parquet.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])
    for text in table.column("text").to_pylist():
        assert ENCODER.ids(text) == np.array(plain_ids(text), "<u4").tobytes()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=40), st.integers(1, 16))
def test_pieces_cover_each_document_and_fill_sequences(lengths, capacity):
    pieces = packing.pack(lengths, capacity, 1.0, 0.5)
    for d, n in enumerate(lengths):
        own = sorted(p for p in pieces if p[0] == d)
        assert [p[1] for p in own] == list(np.cumsum([0] + [p[2] for p in own]))[:-1] and sum(p[2] for p in own) == n
    by = {}
    for _, _, n, s, o in pieces:
        by.setdefault(s, []).append((o, n))
    for own in by.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= capacity
    assert len(by) == -(-sum(lengths) // capacity)


def test_costs_are_balanced():
    lengths = [9, 7, 6, 5, 4, 3, 2, 2, 1, 1]
    cost = {}
    for _, _, n, s, _ in packing.pack(lengths, 20, 1.0, 0.1):
        cost[s] = cost.get(s, 0) + n + 0.1 * n * n
    assert max(cost.values()) - min(cost.values()) < 0.25 * max(cost.values())


def test_query_rows(spark):
    rows = [(1, "a b  c " * 900, "x"), (2, None, "y"), (3, "", None), (4, "word", "z"), (4, "word", "z"), (None, "no id", "q"),
            (7, "y" * 30_000, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(2)
    got = packing.packed_pieces(docs, *FILES, buffer_tokens=3000, with_ids=True).collect()
    want = {}
    for doc_id, text, _ in rows:
        want.setdefault(doc_id, []).append(plain_ids(text or "") + [1])
    for doc_id, texts in want.items():
        own = sorted((r for r in got if r.doc_id == doc_id), key=lambda r: (r.sequence_id, r.offset))
        assert sum(r.length for r in own) == sum(map(len, texts))
        for r in own:
            assert list(np.frombuffer(r.ids, "<u4")) == texts[0][r.start:r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(r.ids) and r.doc_tokens == len(texts[0])
    total = {}
    for r in got:
        total[r.sequence_id] = total.get(r.sequence_id, 0) + r.length
    assert max(total.values()) <= 2048
    assert packing.packed_pieces(docs.filter("false"), PATH).collect() == []
    with pytest.raises(ValueError):
        packing.packed_pieces(docs, PATH, capacity=0)
