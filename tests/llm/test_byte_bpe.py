import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import byte_bpe
from kerbside.llm.catalog import QUERIES, RANKS

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


def both(name):
    path = public_tokenizers.path(name)
    library = tiktoken.Encoding("library", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    return byte_bpe.codec(path, public_tokenizers.PATTERN), library


def ids(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


@pytest.mark.parametrize("name", FILES)
def test_equals_the_library_on_odd_texts(name):
    codec, library = both(name)
    rng = random.Random(13)
    alphabets = ["abcdefgh ", "ab-=*", "aeiou nst'\n\t", "äöüß中文日本語　\x1c\x85٣ⅷ́😀", "0123456789.,-", "A\xa0  \r\n"]
    for i in range(3000):
        text = "".join(rng.choice(alphabets[i % 6]) for _ in range(rng.randrange(200)))
        if i % 3 == 0:
            text += "".join(chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(20))
        assert ids(codec, text) == library.encode_ordinary(text), text
        assert codec.decode(codec.encode(text)) == text.encode()


def test_every_character_is_split_as_the_library_splits_it():
    codec, library = both(FILES[0])
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(every), 4000):
        text = "".join(f"a{c}1" for c in every[start:start + 4000])
        assert ids(codec, text) == library.encode_ordinary(text)


@given(st.text(alphabet="abc", max_size=40), st.permutations(["aa", "ab", "ba", "aab", "bab", "abab", "bb", "cab", "aaaa", "bc"]))
@settings(max_examples=300, deadline=None)
def test_any_order_of_ranks_gives_what_merging_gives(text, order):
    """Also vocabularies no merging would learn: tokens that no merge reaches, parts of higher rank."""
    ranks = {t.encode(): r for r, t in enumerate(["a", "b", "c", *order])}
    codec = byte_bpe.Codec(ranks, r"(?s).+")
    expected = [ranks[text.encode()]] if text.encode() in ranks else [ranks[t] for t in byte_bpe.merged(text.encode(), ranks)]
    assert ids(codec, text) == expected


def test_long_pieces_are_linear_and_exact_over_block_ends(monkeypatch):
    codec, library = both(FILES[0])
    rng = random.Random(3)
    texts = ["".join(rng.choice(letters) for _ in range(40_000)) for letters in ("abcdefghijklmnop", "a", "ab", "=-")]
    monkeypatch.setattr(byte_bpe, "BLOCK", 512)
    for text in texts:
        assert ids(codec, text) == library.encode_ordinary(text)
    monkeypatch.undo()
    assert len(ids(codec, "a" * 1_000_000)) == len(ids(codec, "a" * 8)) * 125_000


def test_rows(spark):
    table = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "one <|endoftext|> two", "x"), (3, "one <|endoftext|> two", "x"), (None, "n", "x")],
                                  "doc_id long, text string, ids string")
    out = byte_bpe.decoded(byte_bpe.encoded(table, *RANKS), *RANKS)
    assert rows(out.select("doc_id", "data")) == sorted(
        [(1, bytearray()), (2, bytearray()), (3, bytearray(b"one <|endoftext|> two")), (3, bytearray(b"one <|endoftext|> two")), (None, bytearray(b"n"))], key=repr)
    assert byte_bpe.encoded(table.limit(0), *RANKS).count() == 0
    other = table.select("text", table.doc_id.cast("string").alias("key"))
    assert byte_bpe.encoded(other, *RANKS, doc_id="key").dtypes == [("doc_id", "string"), ("ids", "binary")]
    assert rows(byte_bpe.decoded(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), *RANKS)) == [(1, bytearray())]


def test_bad_ids_are_refused():
    codec, _ = both(FILES[0])
    with pytest.raises(ValueError, match="no token"):
        codec.decode(np.array([50256], "<u4").tobytes())
    with pytest.raises(ValueError, match="32-bit"):
        codec.decode(b"abc")


def test_query(spark):
    _, library = both(FILES[0])
    sf_dir = "/root/testdata/sf0.001"
    expected = []
    for doc_id, text in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        found = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        expected.append((doc_id, len(found) // 4, hashlib.sha256(found).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert rows(QUERIES["op13_byte_bpe"](spark, sf_dir)) == sorted(expected, key=repr)
