from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pubwatch.functions import abstracts, fixed, rewrite, text

INDEX = "map<string, array<int>>"


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


def test_whitespace_set_is_the_whole_one():
    assert sorted(fixed.WHITESPACE) == [c for c in map(chr, range(0x110000)) if c.isspace()]


def test_strip_and_split_agree_on_whitespace(spark):
    for char in fixed.WHITESPACE:
        assert one(spark, text.strip_space(F.col("x")), f"{char}a b{char}") == "a b"
        assert one(spark, text.words(F.col("x")), f"{char}a{char}b{char}") == ["a", "b"]


def test_no_other_character_splits_words(spark):
    # Surrogates and NUL aside, every character of the first plane stands between two letters.
    codes = [c for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(chr(c), f"a{chr(c)}b") for c in codes], "c string, x string")
    split = df.where(F.size(text.words(F.col("x"))) == 2).select("c").collect()
    assert {r["c"] for r in split} == set(fixed.WHITESPACE)


@pytest.mark.parametrize(
    ("index", "expected"),
    [
        ({"we": [0, 3], "find": [1], "x": [1]}, "we x  we"),
        ({"a": [2]}, "a"),
        ({"a": [0], "b": [4, 6]}, "a    b  b"),
        ({"x": [0], "": [1], "y": [2]}, "x  y"),
        ({"a": [0, 0]}, "a"),
        ({"b": [1], "a": [0]}, "a b"),
        ({}, None),
        ({"a": []}, None),
        ({"a": None, "b": [0]}, "b"),
        (None, None),
    ],
)
def test_restore_abstract(spark, index, expected):
    # JSON keeps the order of the words; a Python dict passed to Spark does not.
    parsed = F.from_json("x", INDEX)
    value = None if index is None else json.dumps(index)
    assert one(spark, abstracts.restore_abstract(parsed), value) == expected


def brute_force(index):
    words = {position: word for word, places in index.items() for position in places}
    if not words:
        return None
    return " ".join(words.get(i, "") for i in range(max(words) + 1)).strip() or None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.dictionaries(
            st.text("abc ", max_size=3), st.lists(st.integers(0, 25), max_size=6), max_size=6
        ),
        min_size=1,
        max_size=30,
    )
)
def test_restore_abstract_equals_brute_force(spark, indexes):
    rows = [(i, json.dumps(index)) for i, index in enumerate(indexes)]
    df = spark.createDataFrame(rows, "i int, x string").select("i", F.from_json("x", INDEX).alias("x"))
    got = df.select("i", abstracts.restore_abstract(F.col("x"))).collect()
    assert dict(got) == {i: brute_force(index) for i, index in enumerate(indexes)}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab é\t\n \x1c'", max_size=40), min_size=1, max_size=30))
def test_index_round_trip(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    back = abstracts.restore_abstract(abstracts.build_inverted_index(F.col("x")))
    got = dict(df.select("i", back).collect())
    assert got == {i: " ".join(t.split()) or None for i, t in enumerate(texts)}


def test_index_equals_long_form(spark):
    df = spark.createDataFrame([(1, "b a b c a b"), (2, ""), (3, None)], "i int, x string")
    entries = df.select("i", F.explode(abstracts.build_inverted_index(F.col("x"))).alias("w", "p"))
    long = df.select("i", F.posexplode(text.words(F.col("x"))).alias("p", "w"))
    grouped = long.groupBy("i", "w").agg(F.sort_array(F.collect_list("p")).alias("p"))
    assert sorted(entries.collect()) == sorted(grouped.collect())


@pytest.mark.parametrize(
    ("response", "en", "he"),
    [
        ("English: a b\nHebrew: c", "a b", "c"),
        ("Hebrew: c English: d", "", "c English: d"),
        ("English: a Hebrew: b Hebrew: z", "a", "b"),
        ("English: a English: b Hebrew: c", "a  b", "c"),
        (" plain \n", "plain", "none"),
        ("English: only", "English: only", "none"),
        (None, None, None),
    ],
)
def test_parse_labels(spark, response, en, he):
    assert tuple(one(spark, text.parse_labels(F.col("x"), "none"), response)) == (en, he)


@pytest.mark.parametrize("url", ["https://h/p$5x\\", "https://h/a?b=$1&c", "plain"])
def test_absolutise_links(spark, url):
    html = "<a href='#art-12'>1</a><a href=\"#art-3\">2</a><a href='#other'>3</a><a href=\"/x\">4</a>"
    expected = (
        f'<a href="{url}#art-12">1</a><a href="{url}#art-3">2</a><a href=\'#other\'>3</a><a href="/x">4</a>'
    )
    assert one(spark, text.absolutise_links(F.col("x"), url), html) == expected
    assert one(spark, text.absolutise_links(F.col("x"), F.lit(url)), html) == expected


def test_extract_anchors(spark):
    html = "<a href='#art-2'>x</a> <a href=\"#art-10\">y</a> #art-3 <a href='#art-2'>z</a>"
    assert one(spark, text.extract_anchors(F.col("x")), html) == ["art-2", "art-10", "art-2"]


def test_split_recipients(spark):
    split = text.split_recipients(F.col("x"))
    assert one(spark, split, " a@x.example, ,b@x.example,") == ["a@x.example", "b@x.example"]
    assert one(spark, split, "") == []


def test_escape_preview_and_sentences(spark):
    assert one(spark, text.escape_html(F.col("x")), '<a & "b">') == "&lt;a &amp; &quot;b&quot;&gt;"
    assert one(spark, text.title_preview(F.col("x")), "t" * 50) == "t" * 40 + "..."
    assert one(spark, text.sentences(F.col("x")), "A b.  C?! d\ne") == ["A b.", "C?!", "d e"]
    assert one(spark, text.lead_sentences(F.col("x"), 2), "A. B. C.") == "A. B."
    assert one(spark, text.tokens(F.col("x")), "Éclair two éclair 1234") == ["éclair", "1234"]


def test_fill_does_not_rescan_values(spark):
    filled = text.fill("{a}-{b}-{a}", a=F.col("x"), b=F.lit(None).cast("string"))
    assert one(spark, filled, "{b} 100% $1 \\") == "{b} 100% $1 \\--{b} 100% $1 \\"


def test_rules_apply_in_order_and_literally(spark):
    rules = [
        rewrite.Rule("regex", "<body[^>]*>", '<body class="$1\\">'),
        rewrite.Rule("literal", "a.c", "X"),
        rewrite.Rule("literal", "X</p>", "Y</p>"),
    ]
    html = '<body style="x">abc a.c</p>'
    assert one(spark, rewrite.apply_rules(F.col("x"), rules), html) == '<body class="$1\\">abc Y</p>'
    with pytest.raises(ValueError, match="unknown rule kind"):
        rewrite.apply_rules(F.col("x"), [rewrite.Rule("other", "a", "b")])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab .!?\n", max_size=30), min_size=1, max_size=40))
def test_lead_is_the_first_of_all_sentences(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    for count in (1, 2, 3):
        whole = F.array_join(F.slice(text.sentences(F.col("x")), 1, count), " ")
        rows = df.select("x", text.lead_sentences(F.col("x"), count).alias("lead"), whole.alias("whole"))
        assert [r["x"] for r in rows.collect() if r["lead"] != r["whole"]] == []


def test_index_of_a_long_text_takes_no_copy_per_word(spark):
    """Each word's places are looked up; a slice would copy all places for every word."""
    text = " ".join(f"w{i}" for i in range(60_000)) + " w7"
    row = spark.createDataFrame([(text,)], "text string")
    index = abstracts.build_inverted_index(F.col("text"))
    plan = row.select(index.alias("index"))._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" not in plan
    back = row.select(index.alias("index")).select(
        F.size("index"), F.col("index")["w7"], abstracts.restore_abstract(F.col("index")) == F.lit(text)
    )
    assert tuple(back.first()) == (60_000, [7, 60_000], True)
