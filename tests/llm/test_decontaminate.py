"""Spaced seeds against brute force over every alignment."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import duckdb
import pytest

from tests.llm.conftest import BENCH, texts, words
from tillroll.llm import decontaminate as dc
from tillroll.llm import queries


def test_masks_find_every_allowed_substitution():
    for gone in itertools.combinations(range(dc.WINDOW), dc.WINDOW - dc.MATCHES):
        assert any(
            not {at + i for i in mask} & set(gone) for mask in dc.MASKS for at in range(dc.WINDOW - mask[-1])
        )


def split(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def brute(rows, items):
    out = Counter()
    for doc_id, text in rows:
        w = split(text)
        for item_id, item in set(items):
            b = split(item)
            if not b:
                continue
            size = min(len(b), dc.WINDOW)
            least = dc.MATCHES if size == dc.WINDOW else -(-8 * size // 10)
            hits = []
            for i in range(len(w) - size + 1):
                for j in range(len(b) - size + 1):
                    same = sum(w[i + k] == b[j + k] for k in range(size))
                    if same >= least:
                        hits.append((i, same))
            if hits:
                ends = [i + size - 1 for i, _ in hits]
                out[doc_id, item_id, len(hits), max(s for _, s in hits), min(i for i, _ in hits), max(ends)] += 1
    return out


@pytest.mark.parametrize("broadcast,in_words", [(0, 0), (0, 64 << 20), (500_000, 0), (500_000, 64 << 20)])
def test_contamination(spark, docs, empty, benchmark, store, monkeypatch, broadcast, in_words):
    monkeypatch.setattr(dc, "BROADCAST_SEEDS", broadcast)
    monkeypatch.setattr(dc, "BROADCAST_BYTES", in_words)
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    rows = [(d, t) for d, t in texts() if len(t or "") < 20000]
    short = words(998, 6)
    other = short.split()
    other[5] = "else"
    rows += [(90, f"a b {short} c"), (91, f"{' '.join(other)} z"), (92, short), (93, " ".join(BENCH.split()[:12])), (94, " ".join(BENCH.split()[:11]))]
    small = store(spark.createDataFrame(rows, "doc_id long, text string"), f"leaks-{broadcast}-{in_words}")
    got = Counter(tuple(r) for r in dc.contamination(small, benchmark).collect())
    assert got == brute(rows, items)
    assert {r[0] for r in got} == {70, 71, 90, 91, 92, 93}
    assert dc.contamination(empty, benchmark).count() == 0 and dc.contamination(docs, benchmark.limit(0)).count() == 0


def test_drop(docs, benchmark):
    left = dc.drop_contaminated(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d) for d, _ in texts() if d not in (70, 71))
    plan = dc.overlaps(docs, benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_short_masks_find_every_allowed_substitution():
    for m, masks in dc.SHORT_MASKS.items():
        for gone in itertools.combinations(range(m), m // 5):
            assert any(not {at + i for i in mask} & set(gone) for mask in masks for at in range(m - mask[-1]))


def test_short_items_with_any_words_replaced(spark, store):
    items = [(m, words(700 + m, m)) for m in range(1, dc.WINDOW)]
    rows, expected = [], set()
    for m, item in items:
        for some in range(m // 5 + 2):
            for gone in itertools.combinations(range(m), some):
                kept = ["qqqq" if i in gone else w for i, w in enumerate(item.split())]
                rows.append((len(rows), f"xx {' '.join(kept)} yy"))
                if some <= m // 5:
                    expected.add((rows[-1][0], m))
    docs = store(spark.createDataFrame(rows, "doc_id long, text string"), "short-docs")
    benchmark = store(spark.createDataFrame(items, "item_id long, text string"), "short-items")
    assert {(r.doc_id, r.item_id) for r in dc.contamination(docs, benchmark).collect()} == expected


def test_short_items_in_sql(spark, store):
    items = [(1, "alpha beta gamma delta epsilon zeta"), (2, "omega psi"), (3, "the"), (4, words(31, 10)), (4, ""), (5, words(32, 11))]
    ten, eleven = words(31, 10).split(), words(32, 11).split()
    rows = [
        "qqqq beta gamma delta epsilon zeta",
        "qqqq beta gamma delta epsilon qqqq",
        "an omega psi here and The end",
        "omega chi psi",
        " ".join(ten[:3] + ["q"] + ten[4:7] + ["q"] + ten[8:]),
        " ".join(ten[:3] + ["q"] + ten[4:7] + ["q", "q"] + ten[9:]),
        " ".join(["q"] + eleven[1:] + ["xx"] + eleven[:10] + ["the"]),
        None,
    ]
    docs = store(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), "sql-docs")
    benchmark = store(spark.createDataFrame(items, "item_id long, text string"), "sql-items")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    con.register("benchmark", benchmark.toArrow())
    expected = Counter(con.execute(queries.ORACLE_SQL["op4_decontaminate"]).fetchall())
    got = Counter(tuple(r) for r in dc.contamination(docs, benchmark).collect())
    assert got == expected == brute(enumerate(rows), items)
    assert {r[:2] for r in got} == {(0, 1), (2, 2), (2, 3), (4, 4), (6, 5), (6, 3)}
    # Items under five words are reported, and no document goes for them.
    assert {r.doc_id for r in dc.drop_contaminated(docs, benchmark).collect()} == {1, 2, 3, 5, 7}


def test_an_item_as_long_as_a_book(spark, store):
    book = [f"w{i}" for i in range(50_000)]
    rows = [(1, " ".join(["a", *book[30_000:30_040], "b"])), (2, " ".join(book[:9])), (3, " ".join(book))]
    docs = store(spark.createDataFrame(rows, "doc_id long, text string"), "book-docs")
    benchmark = store(spark.createDataFrame([(7, " ".join(book))], "item_id long, text string"), "book")
    got = {tuple(r) for r in dc.contamination(docs, benchmark).collect()}
    # The two words around the passage may be replaced ones.
    assert got == {(1, 7, 31, 12, 0, 41), (3, 7, 49_989, 12, 0, 49_999)}
