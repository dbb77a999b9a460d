"""Swap-based packing: ids against the library, whole placements, steps that
raise squared fill, and small blocks against exhaustive search."""

from __future__ import annotations

import random
import sys
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import texts
from tillroll.llm import swap_packing as sp

PATH = P.path("word_bpe_49k.json")
TOK = Tokenizer.from_file(PATH)


def ids_of(text: str | None) -> list[int]:
    return TOK.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), min_size=1, max_size=5))
def test_any_text(batch):
    assert [np.frombuffer(x, "<u4").tolist() for x in sp.word_ids(PATH).encode(batch)] == [ids_of(t) for t in batch]


def test_every_character_and_special_string():
    chars = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0xF900, sys.maxunicode, 997)]
    batch = [f"a{c}b {c} x" for c in chars] + ["a<|endoftext|>b <|startoftext|>", "\x01 x\x01y", ""]
    assert [np.frombuffer(x, "<u4").tolist() for x in sp.word_ids(PATH).encode(batch)] == [ids_of(t) for t in batch]


def fewest(sizes: list[int], length: int) -> int:
    for n in range(1, len(sizes) + 1):
        for way in product(range(n), repeat=len(sizes) - 1):
            fill = Counter()
            for size, b in zip(sizes, (0, *way)):
                fill[b] += size
            if max(fill.values()) <= length:
                return n
    return 0


def test_search_against_exhaustive_search_and_best_fit():
    rng = random.Random(7)
    for _ in range(150):
        sizes = [rng.randint(1, 60) for _ in range(rng.randint(1, 7))]
        found = sp.pack_block(sizes, 60)
        assert sorted(i for b in found for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 60 for b in found)
        assert fewest(sizes, 60) <= len(found) <= len(sp.best_fit_decreasing(sizes, 60))


def test_swaps_empty_sequences_that_best_fit_leaves():
    for bins, sizes, length in [
        ([[0, 1], [2, 3], [4]], [6, 3, 5, 4, 2], 10),  # 3 for 4 between the fuller two, then a move
        ([[0], [1, 2], [3, 4]], [8, 6, 1, 2, 3], 10),  # a move
        ([[0, 1], [2, 3]], [7, 1, 1, 1], 10),  # moves only
        ([[0, 1], [2, 3], [4, 5]], [5, 4, 9, 0 + 1, 3, 2], 12),  # 3+2 go one by one or for 4
        ([[0, 1], [2, 3]], [6, 2, 1, 1], 10),
    ]:
        search = sp.Search(sizes, [list(b) for b in bins], length)
        squares, step = [sum(f * f for f in search.fill)], search.step

        def watched(giver, search=search, squares=squares, step=step):
            done = step(giver)
            if done:
                squares.append(sum(f * f for f in search.fill))
            assert search.fill == [sum(search.sizes[i] for i in b) for b in search.bins]
            return done

        search.step = watched
        left = search.run()
        assert squares == sorted(set(squares)) and len(squares) > 1
        assert len(left) == -(-sum(sizes) // length)


def test_each_kind_of_exchange():
    # giver first: (kind) pieces of the giver, pieces of the other, expected shift
    for own, other, shift in [([5], [4, 4], 1), ([3, 3], [5, 3], 1), ([7], [3, 3, 2], 1)]:
        sizes = own + other
        bins = [list(range(len(own))), list(range(len(own), len(sizes)))]
        search = sp.Search(sizes, bins, max(sum(own), sum(other)) + shift)
        assert search.step(0) and search.fill[1] == sum(other) + shift


@pytest.mark.parametrize("block_tokens", [3000, 4_000_000])
def test_packing_is_whole_and_gapless(spark, docs, empty, store, block_tokens):
    length = 512
    pieces = store(sp.token_pieces(docs, PATH, length, 1, with_ids=True), f"pieces{block_tokens}")
    packed = sp.pack(pieces, length, block_tokens=block_tokens, block_pieces=20)
    rows = packed.collect()
    want = Counter()
    for doc_id, text in texts():
        ids = [*ids_of(text), 1]
        for piece, at in enumerate(range(0, len(ids), length)):
            part = np.array(ids[at : at + length], "<u4").tobytes()
            want[doc_id, piece, at, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= length
    total = sum(r.length for r in rows)
    assert len(bins) <= total / length * 1.1 + 3
    for r in sp.sequences(packed).collect():
        assert len(r.ids) == 4 * r.cu_seqlens[-1] and len(r.doc_ids) == len(r.cu_seqlens)
    none = store(sp.token_pieces(empty, PATH, length, 1), f"none{block_tokens}")
    assert sp.pack(none, length).count() == 0


def test_query_columns_and_layout(spark, docs, store):
    one = store(docs.coalesce(1), "one_file")
    many = store(docs.repartition(23), "many_files")
    counts = []
    for frame in (one, many):
        packed = sp.pack_documents(frame, PATH, length=512)
        assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        counts.append(packed.agg(F.countDistinct("sequence_id")).first()[0])
    assert abs(counts[0] - counts[1]) <= 1
