"""Conversation repair against a plain forward search over whole conversations."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import conversations as conv
from tillroll.llm.queries import ORACLE_SQL

WHITE = " \t\n\x0b\x0c\r"
CLASH = "block long, fault string, edits string, state int, whole boolean, digest string, later boolean"
CLASHING = (1, "x", "y", 2, True, "z", False)


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(key.encode()) % 20
        if code == 1:
            text = ""
        if code == 2:
            text = "".join(c for c in text if c not in ".!?")
        if code == 4:
            role = "user"
        out += [] if code == 0 else [(conv_id, turn, role, text)] * (2 if code == 3 else 1)
    return out


def place(row):
    _, turn, role, text = row
    return turn is not None, turn or 0, role.encode(), hashlib.sha256(text.encode()).digest()


NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FITS = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}


def cheapest(rows):
    """Forward search with (cost, audit) per state; rows are (role, text, fault)."""

    def with_inserts(best):
        for _ in range(3):
            for q, (cost, audit, lines) in list(best.items()):
                to, word = FITS[q]
                better(best, to, (cost + 5, audit + "I", (*lines, f"{word}:")))
        return best

    def better(best, q, new):
        if q not in best or new[:2] < best[q][:2]:
            best[q] = new

    best = {0: (0, "", ())}
    for role, text, fault in rows:
        after: dict = {}
        for q, (cost, audit, lines) in with_inserts(best).items():
            better(after, q, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            if (q, role[:1]) in NEXT:
                better(after, NEXT[q, role[:1]], (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
            to, word = FITS[q]
            better(after, to, (cost + extra + 1, audit + "R", (*lines, f"{word}:{text}")))
        best = after
    best = with_inserts(best)
    return min((best[q] for q in (0, 3) if q in best), key=lambda x: x[:2])


def brute(rows):
    out = []
    kept = damaged(rows)
    for conv_id in {r[0] for r in rows}:
        own = sorted((r for r in kept if r[0] == conv_id), key=place)
        seen, faulty = set(), []
        for _, _, role, text in own:
            end = text.rstrip(WHITE)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[0][:1] for r in faulty]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest(faulty)
        counts = [sum(f[2] == name for f in faulty) for name in ("blank", "duplicate", "truncated")]
        out.append((conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(seed: int, n_conversations: int, hot: int = 0):
    rng = random.Random(seed)
    said = ["Hello there.", "What?", "Yes!", "no end", "  ", "", None, "ok. \n", "Hm…", "Fine.", "Same again."]
    roles = ["user", "assistant", "system", "tool", "", None, "assistant", "user", "agent", "User"]
    rows = []
    for c in range(n_conversations):
        for t in range(rng.randint(1, 9)):
            turn = rng.choice([t, t, t, t + 2, None, -t])
            rows.append((c, turn, rng.choice(roles[: rng.choice([2, 3, 10])]), rng.choice(said) if rng.random() < 0.6 else f"t{rng.random()}."))
    for t in range(hot):  # one conversation with most rows, long runs in it
        rows.append((10**6, t, "user" if t % 500 < 400 else "assistant", f"turn {t}{rng.choice('..x')}"))
    rows += [(None, 1, "user", "a."), (None, None, None, None), (None, 2, "assistant", "b."), (None, 2, "assistant", "b.")]
    return rows


@pytest.mark.parametrize("hot", [0, 3000])
def test_operator_and_sql(spark, store, hot):
    rows = rows_of(hot + 1, 150, hot)
    frame = spark.createDataFrame([(*r, *CLASHING) for r in rows], f"conv_id long, turn long, role string, text string, {CLASH}")
    stored = store(frame.repartition(5), f"talk{hot}")
    want = brute(rows)
    got = conv.repair_digest(conv.damage(stored)).select(*conv.RESULT)
    assert sorted(map(tuple, got.collect()), key=str) == want
    if not hot:
        con = duckdb.connect()
        con.register("conversations", stored.toArrow())
        assert sorted(con.sql(ORACLE_SQL["op11_conversations"]).fetchall(), key=str) == want


def test_the_hot_conversation_lies_in_many_blocks(spark, store):
    rows = [(7, t, "user" if t % 2 else "assistant", f"turn {t}.") for t in range(4000)]
    stored = store(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "hot")
    out = conv.repair(conv.undamaged(stored)).collect()
    assert len({r.block for r in out}) >= 6 and not any(r.whole for r in out)
    audit = "".join(r.edits for r in sorted(out, key=lambda r: (r.role is None, r.turn)))
    assert audit == cheapest([(role, text, None) for _, _, role, text in rows])[1]


def test_no_rows_and_lost_rows(spark, store):
    empty = store(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), "no_talk")
    assert conv.repair_digest(conv.damage(empty)).count() == 0
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    one = store(spark.createDataFrame([(lost, 0, "user", "a.")], "conv_id long, turn long, role string, text string"), "lost")
    row = conv.repair_digest(conv.damage(one)).collect()
    assert [tuple(r) for r in row] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@settings(max_examples=300, deadline=None)
@given(st.text("suaoSUAOx", max_size=8), st.integers(1, 90))
def test_unrolled_choices_are_the_least_of_the_cheapest(symbols, times):
    symbols = "".join(s * (times if k == 1 else 1) for k, s in enumerate(symbols))
    rows = [
        ("none" if s in "oOx" else {"s": "system", "u": "user", "a": "assistant"}[s.lower()], "", "blank" if s == "x" else "truncated" if s.isupper() else None)
        for s in symbols
    ]
    edits, state = conv.unroll(symbols, 0, conv.FINAL, True)
    cost, audit, _ = cheapest(rows)
    assert "".join(edits) == audit and state in conv.ENDS
    assert conv.applied(conv.matrix(symbols), conv.FINAL)[0] == cost


@settings(max_examples=100, deadline=None)
@given(st.text("suaoSUx", max_size=12), st.integers(0, 12))
def test_parts_join_to_the_whole(symbols, cut):
    head, tail = symbols[:cut], symbols[cut:]
    after = conv.applied(conv.matrix(tail), conv.FINAL)
    first, state = conv.unroll(head, 0, after, False)
    second, _ = conv.unroll(tail, state, conv.FINAL, True)
    assert [*first, *second] == conv.unroll(symbols, 0, conv.FINAL, True)[0]


def test_powers_are_plain_products():
    for symbol in "suaoSUAOx":
        plain = conv.UNIT
        for _ in range(13):
            plain = conv.product(plain, conv.power(symbol, 0))
        assert plain == conv.matrix(symbol * 13)
