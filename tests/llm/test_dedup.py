"""Exact, near and window deduplication against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from tests.llm.conftest import texts, words
from tillroll.llm import components, exact_dedup, simhash, suffix_dedup


def test_exact_groups(docs, empty):
    out = exact_dedup.exact_groups(docs, digest_all=True).collect()
    sizes = Counter(t or "" for _, t in texts())
    best: dict = {}
    for d, t in texts():
        best[t or ""] = max(best.get(t or "", -1), -1 if d is None else d)
    digest = {hashlib.sha256(t.encode()).hexdigest(): t for t in sizes}
    assert len(out) == len(texts())
    for r in out:
        text = digest[r.full_sha256]
        assert r.group_size == sizes[text]
        assert r.keep_id == (None if best[text] < 0 else best[text])
    assert Counter(digest[r.full_sha256] for r in out if r.kept) == Counter(sizes.keys())  # one row each
    assert all(r.doc_id == r.keep_id for r in out if r.kept)
    lazily = {r.row_id: r.full_sha256 for r in exact_dedup.exact_groups(docs).collect()}
    assert sum(v is None for v in lazily.values()) > 20  # unique lengths are never hashed in full
    assert exact_dedup.exact_groups(empty).count() == 0
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns and left.count() == len(sizes)


def test_a_full_bitmap_changes_nothing(docs, monkeypatch):
    rows = sorted(map(tuple, exact_dedup.exact_groups(docs, digest_all=True).collect()), key=repr)
    monkeypatch.setattr(exact_dedup, "BITMAP_BITS", 6)
    monkeypatch.setattr(exact_dedup, "_SLOT", "xxhash64({}) & 63")
    assert sorted(map(tuple, exact_dedup.exact_groups(docs, digest_all=True).collect()), key=repr) == rows


def plain_fingerprint(text: str) -> int:
    import re

    import xxhash

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    own = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(own[i : i + 3]) for i in range(len(own) - 2)] or ([" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 50)
    for text in ["", " \t", "A", "a B", "x y Z", "a  b\x0bc d\x1ce f", words(3, 170), "Ä É x " * 40]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    rng = random.Random(radius)
    for fixed in (0, rng.getrandbits(64), (1 << 58) - 1):
        masks = simhash.covering_masks(radius, fixed)
        free = [b for b in range(64) if not fixed >> b & 1]
        for _ in range(400):
            apart = sum(1 << b for b in rng.sample(free, min(radius, len(free))))
            assert any(not m & apart for m in masks)


def clusters(prints: list[int], bits: int) -> list[int]:
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(prints))]


def test_near_groups(docs, empty):
    out = simhash.near_groups(docs).collect()
    prints = [int(r.fingerprint, 16) for r in out]
    assert Counter(prints) == Counter(plain_fingerprint(t or "") for _, t in texts())
    member = clusters(prints, 3)
    low: dict = {}
    for r, m in zip(out, member):
        if r.doc_id is not None:
            low[m] = min(low.get(m, r.doc_id), r.doc_id)
    assert all(r.component_id == low.get(m) for r, m in zip(out, member))
    named = {r.doc_id: r.component_id for r in out}
    assert named[81] == 80 and named[31] == 1
    assert simhash.near_groups(empty).count() == 0
    left = simhash.one_per_group(docs)
    assert left.columns == docs.columns and left.count() == len(set(member))


def test_links_in_dense_groups(spark):
    rng = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for size in (40, 700):  # clouds of close fingerprints, one much larger than a bucket may be
        centre = rng.getrandbits(64)
        for _ in range(size):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    prints |= {rng.getrandbits(64) for _ in range(60)}
    prints = sorted(prints)
    rows = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    found = {frozenset((r.a, r.b)) for r in simhash.links(rows, 3).collect()}
    want = {
        frozenset((simhash._signed(a), simhash._signed(b)))
        for i, a in enumerate(prints)
        for b in prints[:i]
        if (a ^ b).bit_count() <= 3
    }
    assert found == want


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(100, 190)] + [(300, 300), (None, 7), (400, 399)]
    out = {r.vertex: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(61)) and all(out[i] == 100 for i in [*range(100, 190), 200])
    assert out[399] == out[400] == 399 and 300 not in out
    none = spark.createDataFrame([], "a long, b long")
    assert components.components(none).count() == 0


def removed(rows: list[bytes], depth: int) -> list[list[tuple[int, int]]]:
    seen = Counter(d[i : i + depth] for d in rows for i in range(len(d) - depth + 1))
    return [
        suffix_dedup._merge([(i, i + depth) for i in range(len(d) - depth + 1) if seen[d[i : i + depth]] > 1]) for d in rows
    ]


def check_windows(df, rows, depth):
    out = suffix_dedup.remove_repeats(df, depth, with_text=True).collect()
    want = Counter()
    for (doc_id, text), spans in zip(rows, removed([(t or "").encode() for _, t in rows], depth)):
        data = (text or "").encode()
        edges = [0, *(x for s in spans for x in s), len(data)]
        kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
        want[doc_id, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept] += 1
    assert Counter((*tuple(r)[:5], bytes(r.kept)) for r in out) == want


@pytest.mark.parametrize("depth", [200, 40])
def test_windows(docs, empty, depth):
    check_windows(docs, texts(), depth)
    assert suffix_dedup.remove_repeats(empty, depth).count() == 0


@pytest.mark.parametrize("alphabet,depth", [("ab", 20), ("abcd", 24), ("a", 30), ("abc ", 60)])
def test_windows_of_poor_alphabets(spark, store, alphabet, depth):
    rng = random.Random(depth)
    shared = ["".join(rng.choice(alphabet) for _ in range(rng.randint(10, 90))) for _ in range(6)]
    rows = [
        (i, "".join(rng.choice(shared) if rng.random() < 0.4 else "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(0, 9))))
        for i in range(40)
    ]
    df = store(spark.createDataFrame(rows, "doc_id long, text string"), f"poor-{alphabet.strip()}-{depth}")
    check_windows(df, rows, depth)


def test_chunks_do_not_matter(spark, store, monkeypatch):
    import numpy as np

    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    data = np.frombuffer(words(5, 300).encode(), np.uint8)
    small = suffix_dedup.anchors(data, 50, suffix_dedup.GramHash(20, 64 + 50))
    places = set(small[0].tolist())
    assert all(places & set(range(i, i + 31)) for i in range(len(data) - 49))
    copy = suffix_dedup.anchors(np.concatenate([data[7:], data]), 50, suffix_dedup.GramHash(20, 64 + 50))
    inside = {p for p in copy[0].tolist()}
    assert {p - 7 for p in places if 57 <= p < len(data) - 50} <= inside
