from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pubwatch.llm import fill_middle
from pubwatch.llm.fill_middle import FimParams


def brute(key, text, p=FimParams()):
    text, key = text or "", "" if key is None else key
    digest = hashlib.sha256(f"{p.seed}:{key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n, marks = len(text), (p.prefix, p.suffix, p.middle)
    low, high = sorted(x % (n + 1) for x in h[:2])
    parts = text[:low], text[low:high], text[high:]
    if not text or any(m in text for m in marks) or h[2] % 100 >= p.rate:
        return n, "plain", None, None, text
    if h[3] % 100 < p.spm:
        made = marks[1] + parts[2] + marks[0] + parts[0] + marks[2] + parts[1]
        return n, "spm", low, high - low, made
    return n, "psm", low, high - low, marks[0] + parts[0] + marks[1] + parts[2] + marks[2] + parts[1]


TEXTS = [
    "", None, "a", "é", "你好，世界", "🙂🏽‍🚀 x", "<P>", "a<S>b", "tail <M>", "<P", "S>", "<", "<<S", "P><M",
    "é" * 50, "\x00\x00", " \n\t", "x" * 100_000 + "🙂" * 50_000, "ab" * 7, "same", "same",
]


@pytest.mark.parametrize("params", [FimParams(), FimParams(seed="s", rate=100, spm=50, prefix="[.", suffix="[*", middle="[\\")])
def test_transform_and_restore(spark, params):
    rows = [(i % 17, t, 5, "z") for i, t in enumerate(TEXTS * 8)] + [(None, "no id", 1, "z"), (None, None, 1, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, form string")
    made = fill_middle.transform(docs, params)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = sorted((tuple(r) for r in made.collect()), key=str)
    assert found == sorted(((k, *brute(k, t, params)) for k, t, _, _ in rows), key=str)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}
    back = fill_middle.restore(made, params).select("doc_id", "text").collect()
    assert sorted(map(tuple, back), key=str) == sorted(((k, t or "") for k, t, _, _ in rows), key=str)


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "abc", 1, 2)], "doc_id long, text string, id int, h1 int")
    assert fill_middle.transform(docs).collect()[0]["output"] == brute(1, "abc")[-1]
    made = fill_middle.transform(docs.limit(0))
    assert made.count() == 0 and fill_middle.restore(made).count() == 0
    clash = spark.createDataFrame([("psm", "<P>a<S>c<M>b", 3)], "form string, output string, parts int")
    assert tuple(fill_middle.restore(clash).first()) == ("psm", "<P>a<S>c<M>b", 3, "abc")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=6), st.integers(0, 7), st.data())
def test_cuts_lie_between_code_points(texts, lead, data):
    raw = [t.encode() for t in texts]
    buffer = np.frombuffer(b"x" * lead + b"".join(raw) + "é".encode(), np.uint8)
    offsets = np.cumsum([lead, *map(len, raw)]).astype(np.int64)
    draws = [np.array([data.draw(st.integers(0, 2**32 - 1)) for _ in texts]) for _ in "ab"]
    n, first, second, low, high = fill_middle._cuts(buffer, offsets, draws)
    for i, t in enumerate(texts):
        assert n[i] == len(t)
        assert raw[i][: low[i]].decode() == t[: first[i]] and raw[i][: high[i]].decode() == t[: second[i]]
        assert sorted(int(d[i]) % (len(t) + 1) for d in draws) == [first[i], second[i]]


def test_long_batches_are_taken_in_runs(monkeypatch):
    monkeypatch.setattr(fill_middle, "BATCH_BYTES", 10)
    runs = list(fill_middle._slices(np.array([0, 4, 8, 30, 30, 31, 50, 50])))
    assert [r for run in runs for r in range(*run)] == list(range(7))
    assert runs[0] == (0, 2) and runs[1] == (2, 3)
