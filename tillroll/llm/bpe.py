"""Byte-level BPE encoding and decoding (operator 1).

The ranks of a vocabulary file become a model of the ``tokenizers`` library:
each token is spelled through the byte-to-character table (printable bytes
stand for themselves, the others move to U+0100 and up) and each way of
splitting a token into two known tokens is a merge of that token's rank.  The
pre-tokenisation pattern is applied by ``regex``; texts repeat their pieces
(Zipf), so each piece is encoded once per task and then looked up in a table
of bounded size.

Decoding spells each id as the model does and reverses the byte table.  A token
may end inside a character; the bytes therefore go, some tokens at a time,
through an incremental UTF-8 decoder that holds the open ones back until the
character is complete.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models, pre_tokenizers

from tillroll.llm.common import batches, columns, id_text, small_batches

# Characters of the pieces remembered per Python worker.  The table is emptied
# before the next text once it is over, which costs time only.
CACHE_CHARS = 4_000_000
STEP = 4096  # tokens decoded at once


@lru_cache(maxsize=1)
def byte_table() -> dict[int, str]:
    """The byte-to-character table of byte-level BPE vocabularies."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(moved)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merges(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """Every split of every token into two tokens, by the token's rank.

    A rank file merges by the rank of the *joined* token, the leftmost pair
    first.  The library ranks pairs, so the splits of one token take
    neighbouring places.  Two of them can compete for the same bytes only
    where p+q = q+r, and there the left pair must come first: its left part is
    the longer one unless q itself spans more than half of the token.
    """
    out = []
    for token in sorted(ranks, key=ranks.get):
        cuts = [i for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        out += [(token[:i], token[i:]) for i in reversed(cuts)]
    return out


class ByteBpe:
    """Encoder and decoder for one vocabulary; built once per Python worker."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        spell = byte_table()
        spelled = {t: "".join(spell[b] for b in t) for t in self.ranks}
        model = models.BPE(
            vocab={spelled[t]: r for t, r in self.ranks.items()},
            merges=[(spelled[a], spelled[b]) for a, b in merges(self.ranks)],
            ignore_merges=True,
        )
        self.tokenizer = Tokenizer(model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pattern = regex.compile(pattern)
        byte_of = {c: b for b, c in spell.items()}
        self.token_bytes = {i: bytes(byte_of[c] for c in token) for token, i in self.tokenizer.get_vocab().items()}
        self.decimal = {r: str(r) for r in self.token_bytes}
        self.cache: dict[str, list[int]] = {}
        self.cached_chars = 0

    def encode(self, text: str) -> list[int]:
        if self.cached_chars > CACHE_CHARS:
            self.cache, self.cached_chars = {}, 0
        pieces = self.pattern.findall(text)
        cache = self.cache
        missing = [p for p in set(pieces) if p not in cache]
        if missing:
            for piece, got in zip(missing, self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)):
                cache[piece] = got.ids
            self.cached_chars += sum(map(len, missing))
        return [i for p in pieces for i in cache[p]]

    def offsets(self, text: str, ids: list[int]) -> tuple[list[int], list[int]]:
        """Start of each token in bytes, and the character it starts in."""
        data = text.encode("utf-8")
        char_at, n = [], -1
        for b in data:
            n += b & 0xC0 != 0x80
            char_at.append(n)
        starts, at = [], 0
        for i in ids:
            starts.append(at)
            at += len(self.token_bytes[i])
        return starts, [char_at[s] for s in starts]

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        table = self.token_bytes
        return b"".join([table[i] for i in ids])

    def decode_stream(self, ids: Sequence[int], step: int = 1) -> Iterator[str]:
        """Text per ``step`` tokens; bytes of an unfinished character wait for the
        next ones, and a sequence that never completes becomes U+FFFD."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for at in range(0, len(ids), step):
            yield decoder.decode(self.decode_bytes(ids[at : at + step]))
        if tail := decoder.decode(b"", final=True):
            yield tail


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> ByteBpe:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core already
    return ByteBpe(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, with_offsets: bool = False) -> DataFrame:
    """(doc_id, ids array<int>), and with ``with_offsets`` also byte_starts and
    char_starts.

    Whole texts; a null text counts as empty and has no ids.  Rows come out
    one for one, repeated rows included, a null doc_id stays null; other
    input columns are left out.
    """
    small_batches(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))]
    if with_offsets:
        fields += [("byte_starts", pa.list_(pa.int32())), ("char_starts", pa.list_(pa.int32()))]
    schema = pa.schema(fields)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in source:
            rows = []
            for doc_id, text in zip(*columns(batch, "doc_id", "text")):
                ids = bpe.encode(text)
                rows.append((doc_id, ids, *bpe.offsets(text, ids)) if with_offsets else (doc_id, ids))
            yield from batches(rows, schema)

    ddl = "doc_id long, ids array<int>" + (", byte_starts array<int>, char_starts array<int>" if with_offsets else "")
    return id_text(docs).mapInArrow(run, ddl)


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, decoded binary) of (doc_id, ids); null ids decode to nothing."""
    small_batches(encoded.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.binary())])

    def run(source):
        bpe = codec(path, pattern)
        for batch in source:
            rows = [(d, bpe.decode_bytes(ids or ())) for d, ids in zip(*columns(batch, "doc_id", "ids"))]
            yield from batches(rows, schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass; per document its number of tokens, the
    digest of its ids (decimal, joined by commas) and of the decoded bytes,
    and with ``with_ids`` the ids.  Rows as for :func:`encode_documents`."""
    small_batches(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema([*fields, *([("ids", pa.list_(pa.int32()))] if with_ids else [])])

    def run(source):
        bpe = codec(path, pattern)
        for batch in source:
            rows = []
            for doc_id, text in zip(*columns(batch, "doc_id", "text")):
                ids = bpe.encode(text)
                spelled = ",".join([bpe.decimal[i] for i in ids]).encode()
                back = hashlib.sha256()
                for part in bpe.decode_stream(ids, STEP):
                    back.update(part.encode())
                row = (doc_id, len(ids), hashlib.sha256(spelled).hexdigest(), back.hexdigest())
                rows.append((*row, ids) if with_ids else row)
            yield from batches(rows, schema)

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return id_text(docs).mapInArrow(run, ddl + (", ids array<int>" if with_ids else ""))
