from __future__ import annotations

import base64
import hashlib

import pytest
import public_tokenizers
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pubwatch.llm import byte_bpe, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SAMPLES = [
    "",
    " ",
    "a" * 3000,
    " " * 700 + "x" + "\n" * 500,
    "héllo wörld’s 12 345 </s> <s> <|endoftext|> \t\r\n",
    "你好，世界" * 200,
    "don't we'll I've 'S    x​",
    "\x00\x1c\x1d\x85 ▁▁ a▁b",
    "ab" * 2000 + "." * 999 + "=-" * 400,
    "the of and " * 900,
    "🙂🏽‍🚀" * 99,
    "1 \U00010ee7a \U00010ee7",
]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def bpe():
    return byte_bpe.load(RANKS, public_tokenizers.PATTERN)


def ids(data: bytes) -> list[int]:
    return list(memoryview(data).cast("I"))


@pytest.mark.parametrize("text", SAMPLES)
def test_byte_bpe_equals_library(library, text):
    found = bpe().encode(text)
    assert ids(found) == library.encode_ordinary(text)
    assert bpe().decode(found) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_byte_bpe_equals_library_on_any_text(library, text):
    assert ids(bpe().encode(text)) == library.encode_ordinary(text)


def test_byte_bpe_pattern_on_every_character(library):
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(codes), 4096):
        text = "".join(f"a{chr(c)}1 {chr(c)}" for c in codes[start : start + 4096])
        assert ids(bpe().encode(text)) == library.encode_ordinary(text)


def test_rank_queue_takes_ranks_then_positions():
    queue = byte_bpe.RankQueue(50_000)
    for entry in [(49_999, 1), (64, 9), (64, 3), (0, 5), (4096, 2), (64, 7)]:
        queue.push(*entry)
    assert [queue.pop() for _ in range(7)] == [(0, 5), (64, 3), (64, 7), (64, 9), (4096, 2), (49_999, 1), None]


@pytest.mark.parametrize("text", SAMPLES)
@pytest.mark.parametrize("chunk,overlap", [(40, 4), (100, 1), (64, 64)])
def test_chunked_counts_equal_library(pieces, text, chunk, overlap):
    assert token_counts.load(PIECES).count(text, chunk, overlap) == len(pieces.encode(text))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab theé\n你  .", max_size=300))
def test_chunked_counts_equal_library_on_any_text(pieces, text):
    assert token_counts.load(PIECES).count(text, 30, 2) == len(pieces.encode(text))


ROWS = [(1, "a b", 7), (None, None, 8), (1, "a b", 7), (3, "", 9), (4, "x" * 200_000 + " y", 1)]


def test_operators_on_odd_rows(spark, library, pieces):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, n_tokens long")
    texts = [t or "" for _, t, _ in ROWS]
    counted = token_counts.count_tokens(docs, PIECES).collect()
    assert sorted(r["n_tokens"] for r in counted) == sorted(len(pieces.encode(t)) for t in texts)
    assert sorted(r["n_bytes"] for r in counted) == sorted(len(t) for t in texts)
    coded = byte_bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(ids(bytes(r["ids"])) for r in coded) == sorted(library.encode_ordinary(t) for t in texts)
    assert {hashlib.md5(r["decoded"]).digest() for r in coded} == {hashlib.md5(t.encode()).digest() for t in texts}
    assert token_counts.count_tokens(docs.limit(0), PIECES).count() == 0
    assert byte_bpe.encode_decode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
