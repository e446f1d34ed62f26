from __future__ import annotations

import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pubwatch.llm import conversations, queries
from pubwatch.llm import repair_grammar as grammar
from pubwatch.llm.conversations import RepairParams

import __spark_entry__ as entry
from tests.llm.test_queries import SF, rows

SPACE = " \t\n\x0b\x0c\r"


def damaged(table):
    """Rows (conv, turn, role, text) after damage."""
    out = []
    for conv, turn, role, text in table:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def edits(symbols):
    """The least (cost, audit, rows) over all edits, by state; audits are compared whole."""
    legal = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, made) in list(best.items()):
                for role in "ua":
                    new = legal.get((state, role))
                    if new:
                        offer(best, new, (cost + 5, audit + "I", [*made, (None, role)]))
        return best

    def offer(best, state, found):
        if state not in best or found[:2] < best[state][:2]:
            best[state] = found

    best = {"": (0, "", [])}
    for i, (initial, fault) in enumerate(symbols):
        after = {}
        for state, (cost, audit, made) in inserted(best).items():
            offer(after, state, (cost + 2, audit + "D", made))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            if (state, initial) in legal:
                offer(after, legal[state, initial], (cost + extra, audit + "K", [*made, (i, None)]))
            for role in "ua":
                if (state, role) in legal:
                    offer(after, role, (cost + extra + 1, audit + "R", [*made, (i, role)]))
        best = after
    return min((v for k, v in inserted(best).items() if k in ("", "a")), key=lambda v: v[:2])


def brute(table):
    """The contract, conversation by conversation. Rows of one turn may stand in any order but equal ones."""
    hurt, out = damaged(table), []
    for conv in {r[0] for r in table}:
        own = [r[1:] for r in hurt if r[0] == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], place(r)))
        seen, faults = set(), []
        for _, role, text in own:
            bare = text.strip(SPACE)
            if not bare:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [r[1][:1] for r in own]
        turns = {r[0] for r in own if r[0] is not None}
        cost, audit, made = edits(list(zip(initials, faults, strict=True)))
        full = {"u": "user", "a": "assistant"}
        lines = [
            f"{full[role] if role else own[i][1]}:{'' if i is None else own[i][2]}" for i, role in made
        ]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(out, key=str)


def place(row):
    turn, role, text = row
    spot = "" if turn is None else str(turn)
    return hashlib.md5(f"{spot}:{len(role)}:{role}{text}".encode()).digest()


def found(spark, table, monkeypatch, params=None):
    if params:
        monkeypatch.setattr(conversations.repair, "__defaults__", (params, *conversations.repair.__defaults__[1:]))
    schema = "conv_id long, turn long, role string, text string, conv string, place int"
    df = spark.createDataFrame([(*r, "x", 1) for r in table], schema)
    monkeypatch.setattr(queries, "table", lambda *_: df)
    result = queries.op11_conversation_repair(spark, "")
    assert result.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    ]
    return sorted(map(tuple, result.collect()), key=str)


def test_query_equals_brute_force(spark):
    table = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows("conversations")]
    got = entry.queries()["op11_conversation_repair"](spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == brute(table)


def odd_rows():
    table = [(c, t, ("system", "user", "assistant")[(t + (c % 3 > 0)) % 3], f"w{t % 4}" + ".?"[t % 2:][:1] * (t % 5 > 0))
             for c in range(12) for t in range(c)]
    table += [(None, None, None, None), (None, 1, "user", "a."), (20, None, "user", "same."), (20, None, "user", "same.")]
    table += [(21, 5, "user", "same."), (21, 5, "user", "same."), (21, 9, "user", "same."), (21, 7, "", " \t")]
    table += [(22, -(1 << 62), "User", "x!"), (22, 3, "assistant", "x" * 50_000 + "."), (23, 0, "system", "s.")]
    table += [(24, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(300)]
    table += [(25, 1, "assistant", "é。"), (25, 2, "tool", "ß!"), (25, 3, "user", "\xa0")]
    return table + [(26, 4, "user", "again.")] * 90 + [(26, 5, "assistant", "b.")]


@pytest.mark.parametrize("params", [None, RepairParams(chunk=7, grammar=40), RepairParams(chunk=1, grammar=1)])
def test_odd_rows_and_long_conversations(spark, monkeypatch, params):
    assert found(spark, odd_rows(), monkeypatch, params) == brute(odd_rows())


def test_empty_table_and_dropped_conversation(spark, monkeypatch):
    assert found(spark, [], monkeypatch) == []
    conv = next(c for c in range(1000) if not damaged([(c, 0, "user", "a.")]))
    empty = hashlib.sha256().hexdigest()
    assert found(spark, [(conv, 0, "user", "a.")], monkeypatch) == [(conv, 0, 0, 0, 0, 0, 0, "", empty)]


def test_repaired_rows(spark):
    table = [(1, 0, "system", "s."), (1, 1, "assistant", "q?"), (1, 2, "assistant", "a."), (1, 3, "user", "end.")]
    df = spark.createDataFrame(table, "c long, t long, r string, x string")
    result = conversations.repair(df, conv_col="c", turn_col="t", role_col="r", text_col="x")
    assert result.rows.columns == ["c", "position", "r", "x"]
    got = sorted(map(tuple, result.rows.collect()))
    assert got == [(1, 0, "system", "s."), (1, 1, "user", "q?"), (1, 2, "assistant", "a.")]
    assert result.report.first()["audit"] == "KRKD"


CODES = st.lists(st.integers(0, grammar.SYMBOLS - 1), min_size=1, max_size=12).map(bytes)


@settings(max_examples=200, deadline=None)
@given(st.lists(CODES, min_size=1, max_size=30))
def test_grammar_keeps_sequences_and_edits(sequences):
    rules, written = grammar.re_pair(sequences)

    def expand(code):
        return [code] if code < grammar.SYMBOLS else [x for side in rules[code - grammar.SYMBOLS] for x in expand(side)]

    assert [[x for code in out for x in expand(code)] for out in written] == [list(s) for s in sequences]
    pairs = [p for out in written for p in zip(out, out[1:], strict=False)]
    assert all(sum(p == q for q in pairs) < 2 or p[0] == p[1] for p in pairs)
    faults = ("", "blank", "truncated")
    for codes, t in zip(sequences, grammar.transfers(sequences), strict=True):
        row = grammar.times([(0, grammar.EMPTY), None, None, None], t.matrix)
        state, end = grammar.best_end(row)
        (cost, audit), (more, closing) = row[state], grammar.INSERTIONS[state][end]
        want = edits([("suax"[c // 3], faults[c % 3]) for c in codes])
        assert (cost + more, str(audit) + str(closing)) == want[:2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("DIKR", max_size=5), max_size=6), st.lists(st.text("DIKR", max_size=5), max_size=6))
def test_ropes_compare_like_strings(a, b):
    def rope(parts):
        made = grammar.EMPTY
        for part in parts:
            made = made + grammar.Rope(part)
        return made

    x, y = rope(a), rope(b[:1]) + rope(b[1:])
    assert str(x) == "".join(a) and (x < y) == ("".join(a) < "".join(b)) and not x < x
