from __future__ import annotations

import random

import pytest
from pubwatch.llm import near_dup
from pubwatch.llm.components import components
from pubwatch.llm.near_dup import JoinParams


def texts(seed=1, families=60, width=8):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    out = []
    for f in range(families):
        base = [pick.choice(vocabulary) for _ in range(pick.randint(3, 150))]
        for _ in range(width if f else 4 * width):
            copy = list(base)
            for _ in range(pick.randint(0, max(1, len(base) // 40))):
                copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
            out.append(" ".join(copy))
    pick.shuffle(out)
    return out


def brute(rows, similarity=0.8, size=5):
    """Class and link count per row, by looking at all pairs."""
    sets = []
    for _, t in rows:
        words = (t or "").lower().split()
        k = min(size, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= similarity * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    ids = {}
    for i, (key, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(key)
    heads = {r: min((k for k in keys if k is not None), default=None) for r, keys in ids.items()}
    return sorted(((k, heads[find(i)], n) for i, ((k, _), n) in enumerate(zip(rows, links, strict=True))), key=str)


def found(spark, rows, params=JoinParams()):
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, node int, class_id string")
    out = near_dup.near_duplicates(docs, params).collect()
    return sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in out), key=str)


@pytest.mark.parametrize("params", [JoinParams(), JoinParams(block=7, block_words=900), JoinParams(whole_group=6, block=5)])
def test_classes_and_links_equal_brute_force(spark, params):
    rows = list(enumerate(texts()))
    assert found(spark, rows, params) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  two"), (6, "one two three"), (None, "one two"),
        (7, "a b c d e f " * 9000), (8, "a b c d e f " * 9000 + "g"), (9, "lone words in here now"), (9, "lone words in here now"),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_heads_of_classes_stay(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, ""), (5, "q r s t u"), (5, "q r s t u")]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, near_id int")
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == ["doc_id", "text", "near_id"]
    assert sorted(r[0] for r in kept.collect()) == [1, 3, 4, 5]


def test_matched_depth_reaches_recall():
    params = JoinParams()
    depth = near_dup.matched_depth(params)
    assert 1 - (1 - 0.8**depth) ** params.trees >= params.recall > 1 - (1 - 0.8 ** (depth + 1)) ** params.trees


def test_components_of_paths_stars_and_circles(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(500, i) for i in range(501, 540)] + [(900, 901), (901, 902), (902, 900)]
    edges += [(999, i) for i in range(700, 740)] + [(7000, 7000)]
    table = spark.createDataFrame(edges, "a long, b long")
    labels = {r["node"]: r["label"] for r in components(table).collect()}
    assert len(labels) == 60 + 40 + 3 + 41
    groups = [range(1, 61), range(500, 540), range(900, 903), [*range(700, 740), 999]]
    assert [{labels[n] for n in g} for g in groups] == [{1}, {500}, {900}, {700}]
    assert components(table.limit(0)).count() == 0


@pytest.mark.parametrize("whole_group", [5, 8192])
def test_pairs_of_a_group_that_meet_in_no_tree_are_links(spark, whole_group):
    """With two trees many pairs of one large group meet in none; lengths differ up to the threshold."""
    pick = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        copy = [w if pick.random() > 0.01 else f"x{i}" for w in base]
        rows.append((i, " ".join(copy[: pick.choice([244, 260, 280, 300])])))
    rows += [(100, " ".join(base[:244])), (101, " ".join(base[:300])), (102, " ".join(base[:299]))]
    params = JoinParams(trees=2, block=7, whole_group=whole_group)
    assert found(spark, rows, params) == brute(rows)


def test_recall_on_a_whole_table(spark):
    """Links of the texts whose id is divisible by 50 against all rows, by sets of word tuples."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = [(r["doc_id"], (r["text"] or "").lower().split()) for r in docs.select("doc_id", "text").collect()]

    def grams(words):
        size = min(5, len(words))
        return {hash(t) for t in zip(*(words[i:] for i in range(size)), strict=False)}

    asked = {i: grams(words) for i, words in rows if i % 50 == 0}
    true = dict.fromkeys(asked, 0)
    for i, words in rows:
        other = grams(words)
        for key, own in asked.items():
            if key != i and own and other and 0.8 <= len(own) / len(other) <= 1.25:
                common = len(own & other)
                true[key] += common >= 0.8 * (len(own) + len(other) - common) - 1e-9
    found = {r["doc_id"]: r["n_links"] for r in near_dup.near_duplicates(docs).where("doc_id % 50 = 0").collect()}
    assert found.keys() == true.keys()
    assert all(found[key] <= n for key, n in true.items())
    print(f"{sum(found.values())} of {sum(true.values())} links")
    assert sum(true.values()) > 30
    assert sum(found.values()) >= 0.99 * sum(true.values())
