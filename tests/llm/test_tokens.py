"""Byte-level BPE against the rank file's own library, and packing."""

from __future__ import annotations

import hashlib
import random
import sys

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import texts
from tillroll.llm import bpe, packing

PATH = P.path("byte_bpe_multi_50k.tiktoken")
CODEC = bpe.codec(PATH, P.PATTERN)
RANKS = packing.encoder(PATH, P.PATTERN)


def same(text: str) -> None:
    ids = CODEC.encode(text)
    assert ids == RANKS.encode_ordinary(text)
    assert CODEC.decode_bytes(ids) == text.encode()
    assert "".join(CODEC.decode_stream(ids)) == text


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_any_text(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.text("aabbé 1'st\n€", max_size=60))
def test_repetitive_text(text):
    same(text)


def test_every_character_is_split_alike():
    for low in range(0, sys.maxunicode + 1, 2000):
        chars = [chr(c) for c in range(low, min(low + 2000, sys.maxunicode + 1)) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}1 {c}b" for c in chars)
        assert CODEC.encode(text) == RANKS.encode_ordinary(text), hex(low)


def test_offsets_point_at_bytes_and_characters():
    text = "aé€𝄞 naïve"
    ids = CODEC.encode(text)
    starts, chars = CODEC.offsets(text, ids)
    data = text.encode()
    for start, char, i in zip(starts, chars, ids):
        assert data[start:].startswith(CODEC.token_bytes[i])
        assert len(data[:start].decode("utf-8", "ignore")) == char


def test_a_forgetful_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_CHARS", 10)
    for _, text in texts():
        same(text or "")


def test_operator(docs, empty):
    out = {}
    for r in bpe.round_trip(docs, PATH, P.PATTERN, with_ids=True).collect():
        out.setdefault(r.doc_id, set()).add((r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)))
    for doc_id, text in texts():
        ids = RANKS.encode_ordinary(text or "")
        ids_digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (len(ids), ids_digest, hashlib.sha256((text or "").encode()).hexdigest(), tuple(ids)) in out[doc_id]
    assert bpe.round_trip(docs, PATH, P.PATTERN).count() == len(texts())
    assert bpe.round_trip(empty, PATH, P.PATTERN).count() == 0
    encoded = bpe.encode_documents(docs, PATH, P.PATTERN, with_offsets=True)
    back = bpe.decode_documents(encoded, PATH, P.PATTERN)
    assert sorted(bytes(r.decoded) for r in back.collect()) == sorted((t or "").encode() for _, t in texts())


@pytest.mark.parametrize("length", [1, 7, 64, 2048])
def test_best_fit_equals_a_plain_search(length):
    rng = random.Random(length)
    for _ in range(40):
        sizes = [rng.randint(1, length) for _ in range(rng.randint(0, 90))]
        rows = packing.best_fit_decreasing(sizes, length)
        assert sorted(i for row in rows for i in row) == list(range(len(sizes)))
        room: list[int] = []
        for size in sorted(sizes, reverse=True):
            fits = [(r, k) for k, r in enumerate(room) if r >= size]
            if fits:
                room[min(fits)[1]] -= size
            else:
                room.append(length - size)
        assert sorted(room) == sorted(length - sum(sizes[i] for i in row) for row in rows)


@pytest.mark.parametrize("block", [200, 4_000_000])
def test_packing_is_lossless(docs, empty, block):
    length, pad = 128, 50256
    found: dict = {}
    for r in packing.pack_documents(docs, PATH, P.PATTERN, length, pad, block).collect():
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == len(places) == length and (ids[r.n_tokens :] == pad).all() and r.cu_seqlens[-1] == r.n_tokens
        for a, b, doc, start in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.doc_starts):
            assert places[a:b].tolist() == list(range(b - a))
            found.setdefault(doc, []).append((start, tuple(ids[a:b].tolist())))
    want: dict = {}
    for doc, text in texts():
        ids = RANKS.encode_ordinary(text or "")
        want.setdefault(doc, []).extend((i, tuple(ids[i : i + length])) for i in range(0, len(ids), length))
    assert {d: sorted(s) for d, s in found.items()} == {d: sorted(s) for d, s in want.items() if s}
    assert packing.pack_documents(empty, PATH, P.PATTERN, length).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(docs, PATH, P.PATTERN, 1 << 16)


def test_fill_does_not_depend_on_files(spark, scratch):
    length, fills = 2048, []
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    for files in (1, 200):
        path = str(scratch / f"docs-{files}")
        documents.repartition(files).write.parquet(path)
        spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a split per file
        try:
            rows = packing.pack_documents(spark.read.parquet(path), PATH, P.PATTERN, length).select("n_tokens", "doc_ids").collect()
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
        fills.append(sum(r.n_tokens for r in rows) / length / len(rows))
        assert len({d for r in rows for d in r.doc_ids}) == documents.where("text != ''").select("doc_id").distinct().count()
    assert abs(fills[0] - fills[1]) < 0.01 and min(fills) > 0.98


def test_stored_rows_as_matrices(spark, docs, empty, scratch):
    length, path = 128, str(scratch / "packed")
    packed = packing.pack_documents(docs, PATH, P.PATTERN, length)
    packing.write_packed(packed, path, length)
    rows, shape = packing.read_packed(spark, path)
    found = []
    for batch in rows.toArrow().to_batches():
        ids, positions, bounds = packing.matrices(batch, length)
        assert ids.shape == positions.shape == (batch.num_rows, length)
        flat, places = ids.reshape(-1), positions.reshape(-1)
        for begin, end in bounds:
            assert begin // length == (end - 1) // length and places[begin:end].tolist() == list(range(end - begin))
            found.append(tuple(flat[begin:end].tolist()))
    want = [RANKS.encode_ordinary(text or "") for _, text in texts()]
    assert sorted(found) == sorted(tuple(ids[i : i + length]) for ids in want for i in range(0, len(ids), length))
    assert (shape.length, shape.rows, shape.segments) == (length, rows.count(), len(found))
    assert shape.tokens == sum(map(len, want))
    packing.write_packed(packing.pack_documents(empty, PATH, P.PATTERN, length), f"{path}-none", length)
    assert packing.read_packed(spark, f"{path}-none")[1].rows == 0
