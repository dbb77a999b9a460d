"""Alignment of two tokenizers against a plain walk over both token lists."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, decoders

from tests.llm.conftest import texts
from tillroll.llm import alignment, pieces

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
ODD = [
    (200, "a  b\nc \n d  \t e "), (201, "<|endoftext|> <s> </s><unk> <0x41>"), (202, " lead"), (203, "▁ ▁x a▁b"), (204, " "),
    (205, "ﬁ Å x \x1c y z\r\n q"), (206, "same same same"), (207, "end \n"), (208, "\0 nul"), (209, "\n\n word"),
]


def char_bytes() -> dict[str, bytes]:
    """The byte table as the library itself decodes it."""
    decode = decoders.ByteLevel().decode
    own = {chr(c): bytes([c]) for c in [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]}
    rest = [b for b in range(256) if bytes([b]) not in own.values()]
    table = own | {chr(0x100 + i): bytes([b]) for i, b in enumerate(rest)}
    assert all(decode([c]) == b.decode() for c, b in table.items() if b < b"\x80")
    return table


CHARS = char_bytes()


def plain(text: str | None):
    """(a_ids, b_ids, groups, links) by walking both lists byte by byte."""
    if not text:
        return [], [], [], []
    a_ids = A.encode(" " + text, add_special_tokens=False).ids
    b_ids = B.encode(text)
    a = [b"".join(CHARS[c] for c in A.id_to_token(i)) for i in a_ids]
    b = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    data = (" " + text).encode()
    if b"".join(a) != data or b"".join(b) != data:
        return [], [], [], []
    groups, links, i, j, p, q = [], [], 0, 0, 0, 0
    own_a, own_b = [], []
    while i < len(a) or j < len(b):
        if p <= q:
            own_a.append(a_ids[i])
            p += len(a[i])
            i += 1
        else:
            own_b.append(b_ids[j])
            q += len(b[j])
            j += 1
        if p == q:
            groups.append((own_a, own_b))
            links.append((a_ids[i - 1], b_ids[j - 1]))
            own_a, own_b = [], []
    return a_ids, b_ids, groups, links


def brute(rows):
    found = [(doc_id, *plain(text)) for doc_id, text in rows]
    counts = Counter(pair for *_, links in found for pair in links)
    best: dict[int, int] = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for doc_id, a_ids, b_ids, groups, links in found:
        spelled = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        n_best = sum(counts[pair] == best[pair[1]] for pair in links)
        digest = hashlib.sha256(spelled.encode()).hexdigest() if a_ids else ""
        sums = n_best, sum(counts[pair] for pair in links)
        out.append((doc_id, len(a_ids), len(b_ids), len(groups), len(links), *sums, digest))
    return sorted(out, key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é\n\t▁<>|s€ \x1c.1"), max_size=40), min_size=1, max_size=4))
def test_parts_equal_whole_texts(batch):
    own = alignment.aligner(*PATHS)
    at, ends, numbers, values = own.parts(batch)
    start = 0
    for text, end in zip(batch, ends.tolist()):
        a_ids, b_ids, groups, links = plain(text)
        spelled = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        part = at[start:end].tolist()
        assert ";".join(values[0][p].decode() for p in part) == spelled
        assert numbers[at[start:end]].sum(0).tolist() == [len(a_ids), len(b_ids), len(groups), len(links)]
        start = end


@pytest.mark.parametrize("limit", [4_000_000, 0])
def test_operator(spark, docs, empty, store, limit, monkeypatch):
    odd = store(docs.sparkSession.createDataFrame(ODD, "doc_id long, text string").repartition(2), f"odd{limit}")
    both = store(docs.select("doc_id", "text").unionByName(odd), f"both{limit}")
    rows = [tuple(r) for r in alignment.align_digest(both, *PATHS, broadcast_pairs=limit).collect()]
    assert sorted(rows, key=str) == brute(texts() + ODD)
    assert alignment.align_digest(empty, *PATHS, broadcast_pairs=limit).count() == 0


def test_groups_cut_the_ids(docs):
    for r in alignment.align(docs, *PATHS).collect():
        assert len(r.a_ends) == len(r.b_ends) and [*r.a_ends[-1:]] == [len(r.a_ids)] * bool(r.a_ends)
        assert sorted(set(r.a_ends)) == r.a_ends and sorted(set(r.b_ends)) == r.b_ends


def test_a_forgetful_table_changes_nothing():
    own = alignment.aligner(*PATHS)
    words = pieces.Pieces(own._words, 4, 2, limit=3)
    want = pieces.Pieces(own._words, 4, 2)
    for _, text in texts():
        lists = [(text or "").split(" ")]
        got, ref = words.slots(lists)[0], want.slots(lists)[0]
        assert (words.numbers[got] == want.numbers[ref]).all()
        assert [words.values[0][i] for i in got] == [want.values[0][i] for i in ref]
        if words.full():
            words.trim()
    assert len(words.slot) < len(want.slot)
