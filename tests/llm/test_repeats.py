from __future__ import annotations

import random

import numpy as np
import pytest
from pubwatch.llm import repeats
from pubwatch.llm.repeats import RepeatParams


def brute(texts, length):
    places = {}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        for s in range(len(raw) - length + 1):
            places.setdefault(raw[s : s + length], []).append((i, s))
    marks = [np.zeros(len((t or "").encode()), bool) for t in texts]
    for where in places.values():
        if len(where) > 1:
            for i, s in where:
                marks[i][s : s + length] = True
    return [bytes(np.frombuffer((t or "").encode(), np.uint8)[~m]) for t, m in zip(texts, marks, strict=True)]


def corpus(seed, many=120):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdeé") for _ in range(pick.randint(1, 7)))
    passages = [" ".join(word() for _ in range(n)) for n in (6, 12, 14, 20, 60, 60)]
    out = []
    for _ in range(many):
        parts = [" ".join(word() for _ in range(pick.randint(0, 30))) for _ in range(pick.randint(1, 4))]
        parts.insert(pick.randrange(len(parts) + 1), pick.choice(passages))
        out.append(" ".join(parts))
    out += pick.sample(out, 10)
    out += [out[0][10:] + "z", "y" + out[1][:-9], "ab" * 400, "x" * 900, "x" * 55, None, "", out[3] + "!" + out[3]]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("params", [RepeatParams(50, 8), RepeatParams(50, 8, hot=2), RepeatParams(64, 32, bucket=16)])
def test_kept_bytes_equal_brute_force(spark, seed, params):
    texts = corpus(seed)
    rows = [(i if i % 17 else None, t, 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int")
    found = repeats.remove_repeats(docs, params).collect()
    assert sorted(bytes(r["kept"]) for r in found) == sorted(brute(texts, params.length))
    for r in found:
        gone = sum(s["high"] - s["low"] for s in r["spans"])
        assert r["n_bytes"] == gone + len(r["kept"])
        edges = [x for s in r["spans"] for x in (s["low"], s["high"])]
        assert edges == sorted(set(edges))


def test_repeated_id_and_empty_table(spark):
    pick = random.Random(1)
    text = "".join(pick.choice("abcdefgh ") for _ in range(900))
    rows = [(1, text), (1, text), (1, text[::-1]), (2, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.remove_repeats(docs).collect()
    assert sorted(len(r["kept"]) for r in found) == [0, 0, 5, 900]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_multikey_sort_equals_plain_sort():
    random_words = np.random.default_rng(1).integers(0, 3, (500, 6)).astype(np.uint64)
    order, common = repeats.multikey_sort(random_words)
    rows = [tuple(r) for r in random_words[order]]
    assert rows == sorted(map(tuple, random_words))
    for i in range(1, len(rows)):
        same = next((k for k in range(6) if rows[i][k] != rows[i - 1][k]), 6)
        assert common[i] == same


def test_every_window_has_its_anchor():
    data = np.random.default_rng(2).integers(0, 4, 3000).astype(np.uint8)
    params = RepeatParams(100, 16)
    at, _, first, last = repeats.anchors(data, params)
    assert first[0] == 0 and last[-1] == len(data) - 100 and (first[1:] == last[:-1] + 1).all()
    assert (at >= last).all() and (at + 16 <= first + 100).all()


def with_common_line(many):
    pick = random.Random(7)
    word = lambda: "".join(pick.choice("abcdefghijklmnop") for _ in range(9))
    line = " ".join(word() for _ in range(8))
    return ["\n".join(x for _ in range(5) for x in (line, word(), word() * 2)) for _ in range(many)]


def test_a_hot_gram_is_split(spark, monkeypatch):
    texts = with_common_line(400)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    plans = {}

    def noting(df, name):
        df.collect()
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return materialise(df, name)

    materialise = repeats.materialise
    monkeypatch.setattr(repeats, "materialise", noting)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.maxPartitionBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = repeats.remove_repeats(docs, RepeatParams(50, 8)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(bytes(r["kept"]) for r in found) == sorted(brute(texts, 50))
    assert "SortMergeJoin(skew=true)" in plans["repeat-shared"]


def test_a_hot_context_is_not_dealt_by_key(spark):
    texts = with_common_line(400)
    numbered = [(i, i, t) for i, t in enumerate(texts + texts[:1] * 300)]
    rows = spark.createDataFrame(numbered, "id int, key long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        plan = repeats.repeated_spans(rows, RepeatParams(50, 8))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "LeftSemi" in plan and "hashpartitioning(gram" not in plan
