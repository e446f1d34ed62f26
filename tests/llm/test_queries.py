"""The registered queries on whole test tables, against DuckDB, libraries or brute force."""

from __future__ import annotations

import base64
import hashlib
import html
import re

import duckdb
import pytest
import public_tokenizers
import sentencepiece
import tiktoken
from pubwatch.llm import queries

import __spark_entry__ as entry
from tests.compare import TESTDATA, connect, differences
from tests.llm.test_near_dup import brute as brute_near
from tests.llm.test_repeats import brute as brute_repeats

SF = str(TESTDATA / "sf0.01")
SMALL = str(TESTDATA / "sf0.001")


def run(spark, name, sf=SF):
    return entry.queries()[name](spark, sf).collect()


def rows(name, sf=SF):
    return duckdb.sql(f"select * from '{sf}/{name}.parquet'").to_df().to_dict("records")


@pytest.mark.parametrize("name", sorted(queries.all_oracles()))
def test_query_equals_twin(spark, name):
    found = entry.queries()[name](spark, SF)
    assert differences(found, connect(SF), queries.all_oracles()[name]) == []


def test_all_thirteen_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1


def test_token_counts_equal_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    want = {d["doc_id"]: len(model.encode(d["text"])) for d in rows("documents")}
    found = run(spark, "op1_token_counts")
    assert {r["doc_id"]: r["n_tokens"] for r in found} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in found)


def test_byte_bpe_equals_the_library(spark):
    with open(queries.BPE_RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r["doc_id"]: r for r in run(spark, "op7_byte_bpe")}
    docs = rows("documents")
    assert len(found) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d["text"])
        r = found[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert r["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()


def test_main_text_is_the_article(spark):
    found = {r["page_id"]: r for r in run(spark, "op6_main_text")}
    for p in rows("pages"):
        article = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        parts = re.split(r"</?(?:h1|p)>", article)
        texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in parts]
        assert found[p["page_id"]]["text"] == "\n".join(t for t in texts if t)


def test_near_duplicates_equal_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in rows("documents", SMALL)]
    found = run(spark, "op8_near_duplicates", SMALL)
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in found), key=str) == brute_near(docs)


def test_repeated_strings_equal_brute_force(spark):
    docs = rows("documents")
    kept = brute_repeats([d["text"] for d in docs], 400)
    found = {r["doc_id"]: r for r in run(spark, "op9_repeated_strings")}
    for d, rest in zip(docs, kept, strict=True):
        r = found[d["doc_id"]]
        assert r["kept_sha256"] == hashlib.sha256(rest).hexdigest()
        assert r["n_bytes"] - r["n_removed"] == len(rest)
        assert (r["n_spans"] == 0) == (r["n_removed"] == 0)


def test_scores_are_reruns(spark):
    assert sorted(run(spark, "op10_toxicity", SMALL)) == sorted(run(spark, "op10_toxicity", SMALL))
