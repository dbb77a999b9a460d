"""Packing of whole documents into sequences by swap-based local search
(operator 12).

Documents are encoded once; one longer than a sequence is cut into full pieces
and a rest.  Pieces are dealt by hash into blocks of a set number of tokens, so
that sequences fill alike whatever the files look like.  Within a block they
start out by best fit; then the least filled sequence gives its pieces away:
by a move into another's room, or by exchanges (one for one, two for one, one
for two) that shift tokens from it into a fuller one.  Each step raises the sum
of squared fills, so the search ends, and a sequence that is empty goes.
Sequences a block could not fill are dissolved and dealt again with those of
the other blocks, in rounds of at most half as many blocks.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm.common import Scratch, columns, numbered, small_batches
from tillroll.llm.packing import best_fit_decreasing
from tillroll.llm.pieces import Pieces

LENGTH, END_ID = 4096, 1
BLOCK_TOKENS, BLOCK_PIECES = 4_000_000, 50_000
# A sequence is dissolved for the next round if it lacks more than this share.
OPEN_SHARE = 0.005
# Sequences, the least filled first, that a sweep lets give; steps of a block's
# search.  They bound time only: pieces are placed in any case.
GIVERS, STEPS = 16, 5000
# Pairs are formed of this many pieces of a sequence, the largest ones: small
# ones have moved on their own before pairs are looked for.
PAIRED = 32

# Words remembered per worker, and encoded together as one text.
WORDS, JOINED, MARK = 1_200_000, 2000, "\x01"

# Python's str.split also cuts at U+001C to U+001F, which are no white space here.
_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
_NO_WHITE = re.compile("[\x1c-\x1f]")


def words_of(text: str) -> list[str]:
    if _NO_WHITE.search(text):
        return [w for w in _WHITE.split(text) if w]
    return text.split()


class WordIds:
    """Ids of texts by a vocabulary whose tokens never cross white space."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # Words are encoded many at once; a control character that is a word
        # and a token of its own tells them apart.
        self.mark = self._ids(MARK)[0] if len(self._ids(MARK)) == 1 else None
        self.words = Pieces(self._encode, 1, 1, limit=WORDS)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _encode(self, words: list[str]) -> tuple[np.ndarray, list[list[bytes]]]:
        found: list[bytes] = []
        for k in range(0, len(words), JOINED):
            own = words[k : k + JOINED]
            ids = self._ids(f" {MARK} ".join(own))
            at = np.flatnonzero(ids == self.mark)
            if self.mark is None or len(at) != len(own) - 1:
                found += [self._ids(word).tobytes() for word in own]
                continue
            data = np.delete(ids, at).tobytes()
            bounds = [0, *(4 * (at - np.arange(len(at)))).tolist(), len(data)]
            found += [data[p:q] for p, q in zip(bounds, bounds[1:])]
        return np.array([len(x) // 4 for x in found], np.int64).reshape(len(found), 1), [found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit numbers."""
        if self.words.full():
            self.words.trim()
        at, ends = self.words.slots([words_of(t) for t in texts])
        places, spell = at.tolist(), self.words.values[0].__getitem__
        bounds = [0, *ends.tolist()]
        return [b"".join(map(spell, places[p:q])) for p, q in zip(bounds, bounds[1:])]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core already
    return WordIds(path)


def token_pieces(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(row_id, doc_id, piece, start, length, ids_crc32): every document's ids and
    the end id, cut into pieces of ``length`` ids; with ``with_ids`` also ids
    (little-endian unsigned 32-bit numbers).

    Whole texts; a null or empty text has the end id alone.  Repeated rows come
    each on their own (``row_id`` tells them apart), a null doc_id stays null.
    """
    small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def run(source):
        own = word_ids(path)
        for batch in source:
            row_ids, doc_ids, texts = columns(batch, "row_id", "doc_id", "text")
            rows = []
            for row_id, doc_id, ids in zip(row_ids, doc_ids, own.encode(texts)):
                ids = memoryview(ids + end)
                for piece, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    row = (row_id, doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part.tobytes()) if with_ids else row)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    ints = ("row_id", "doc_id", "piece", "start", "length", "ids_crc32")
    schema = pa.schema([(n, pa.int32() if n == "piece" else pa.int64()) for n in ints] + [("ids", pa.binary())] * with_ids)
    ddl = "row_id long, doc_id long, piece int, start long, length long, ids_crc32 long"
    return numbered(docs).mapInArrow(run, ddl + (", ids binary" if with_ids else ""))


class Search:
    """Local search over the sequences of one block."""

    def __init__(self, sizes: list[int], bins: list[list[int]], length: int):
        self.sizes, self.bins, self.length = sizes, bins, length
        self.fill = [sum(sizes[i] for i in b) for b in bins]

    def run(self) -> list[list[int]]:
        least = -(-sum(self.sizes) // self.length)
        steps, moved = 0, True
        while moved and steps < STEPS and sum(map(bool, self.bins)) > least:
            moved = False
            open_bins = [b for b in range(len(self.bins)) if self.bins[b] and self.fill[b] < self.length]
            for giver in sorted(open_bins, key=lambda b: self.fill[b])[:GIVERS]:
                while self.bins[giver] and steps < STEPS and self.step(giver):
                    moved, steps = True, steps + 1
        return [b for b in self.bins if b]

    def step(self, giver: int) -> bool:
        """Shift tokens out of ``giver`` into a sequence that is as full or
        fuller: by a move, or by the exchange that shifts most."""
        least, top = self.fill[giver], self.length
        others = [b for b in range(len(self.bins)) if b != giver and self.bins[b] and least <= self.fill[b] < top]
        if not others:
            return False
        room = np.array([self.length - self.fill[b] for b in others])
        own = sorted(self.bins[giver], key=lambda i: -self.sizes[i])
        for i in own:  # a move into the least room that takes the piece
            fits = np.flatnonzero(room >= self.sizes[i])
            if len(fits):
                self.swap(giver, [i], others[fits[np.argmin(room[fits])]], [])
                return True
        at = np.repeat(np.arange(len(others)), [len(self.bins[b]) for b in others])
        items = [(i,) for b in others for i in self.bins[b]]
        singles = [(i,) for i in own]
        pairs = [(i, j) for k, i in enumerate(own[:PAIRED]) for j in own[k + 1 : PAIRED]]
        best = max(self.shift(singles, items, at, others, room), self.shift(pairs, items, at, others, room))
        if not best[0]:
            of_two, at_two = [], []
            for k, b in enumerate(others):
                large = sorted(self.bins[b], key=lambda i: -self.sizes[i])[:PAIRED]
                two = [(i, j) for n, i in enumerate(large) for j in large[n + 1 :]]
                of_two += two
                at_two += [k] * len(two)
            best = self.shift(singles, of_two, np.array(at_two, int), others, room)
        if not best[0]:
            return False
        _, given, other, taken = best
        self.swap(giver, list(given), other, list(taken))
        return True

    def shift(self, given: list[tuple], taken: list[tuple], at: np.ndarray, others: list[int], room: np.ndarray) -> tuple:
        """(tokens shifted, given, other, taken) of the exchange that shifts most."""
        best = (0, (), -1, ())
        if not taken:
            return best
        back = np.array([sum(self.sizes[i] for i in x) for x in taken])
        for x in given:
            by = sum(self.sizes[i] for i in x) - back
            by[(by > room[at]) | (by < 0)] = 0
            k = int(np.argmax(by))
            if by[k] > best[0]:
                best = (int(by[k]), x, others[at[k]], taken[k])
        return best

    def swap(self, a: int, given: list[int], b: int, taken: list[int]) -> None:
        self.bins[a] = [i for i in self.bins[a] if i not in given] + taken
        self.bins[b] = [i for i in self.bins[b] if i not in taken] + given
        by = sum(self.sizes[i] for i in given) - sum(self.sizes[i] for i in taken)
        self.fill[a] -= by
        self.fill[b] += by


def pack_block(sizes: list[int], length: int) -> list[list[int]]:
    """Sequences of piece numbers, none over ``length``."""
    return Search(sizes, best_fit_decreasing(sizes, length), length).run()


def _placed(part: pa.Table, length: int) -> pa.Table:
    order = np.lexsort([part["piece"].to_numpy(), part["row_id"].to_numpy()])
    part = part.take(order)
    sizes = part["length"].to_numpy().tolist()
    sequence, offset, fill = (np.zeros(len(sizes), np.int64) for _ in range(3))
    for n, own in enumerate(pack_block(sizes, length)):
        at = 0
        for i in own:
            sequence[i], offset[i] = n, at
            at += sizes[i]
        fill[own] = at
    columns = {"sequence": sequence, "offset": offset, "fill": fill}
    return pa.table({**{n: part[n] for n in ("row_id", "piece", "length", "block")}, **columns})


def pack(
    pieces: DataFrame, length: int = LENGTH, block_tokens: int = BLOCK_TOKENS, block_pieces: int = BLOCK_PIECES
) -> DataFrame:
    """``pieces`` (a stored table with row_id, piece and length) with
    ``sequence_id`` and ``offset`` of each, gapless from 0 in every sequence.

    A block has about ``block_tokens`` tokens and ``block_pieces`` pieces at
    most, by an even hash of (row_id, piece).  An empty table stays empty.
    """
    scratch = Scratch(pieces.sparkSession, "packing")
    rest, done, number = pieces.select("row_id", "piece", "length"), [], 0
    ddl = "row_id long, piece int, length long, block long, sequence long, offset long, fill long"

    def blocks_of(part: DataFrame) -> int:
        size = part.agg(F.sum("length").alias("tokens"), F.count("*").alias("n")).first()
        return max(1, -(-(size.tokens or 0) // block_tokens), -(-size.n // block_pieces))

    blocks = blocks_of(rest)
    while True:
        block = F.pmod(F.xxhash64("row_id", "piece", F.lit(number)), F.lit(blocks)).alias("block")
        placed = rest.select("*", block).groupBy("block").applyInArrow(lambda part: _placed(part, length), ddl)
        placed = scratch.write(placed, f"round{number}")
        named = placed.withColumn("sequence_id", F.lit(number << 56) + F.shiftleft("block", 24) + F.col("sequence"))
        closed = F.col("fill") > length * (1 - OPEN_SHARE)
        rest, before, number = placed.where(~closed).select("row_id", "piece", "length"), blocks, number + 1
        blocks = blocks_of(rest) if before > 1 else 1
        if 2 * blocks > before:  # one block, or too much left for another round to gain
            done.append(named)
            break
        done.append(named.where(closed))
    places = done[0]
    for more in done[1:]:
        places = places.unionByName(more)
    return pieces.join(places.select("row_id", "piece", "sequence_id", "offset"), ["row_id", "piece"])


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece (from 0), start (its document's ids
    before it), length, ids_crc32 (unsigned), sequence_id, offset; with
    ``with_ids`` also ids.

    ``docs`` must be a stored table.  A null or empty text is one piece with the
    end id alone; repeated rows are packed each, a null doc_id stays null; other
    columns are left out.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.write(token_pieces(docs, path, length, end_id, with_ids), "pieces")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pack(pieces, length).select(*names, *["ids"] * with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, cu_seqlens) of rows with ids: a training
    row's ids one after the other, its documents and where each ends."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id", "length")))  # one sequence: at most its length
    row = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    ends = F.transform("parts", lambda p: (p["offset"] + p["length"]).cast("int"))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda ids, p: F.concat(ids, p["ids"]))
    return row.select("sequence_id", joined.alias("ids"), F.col("parts.doc_id").alias("doc_ids"), ends.alias("cu_seqlens"))
