"""Packing of token ids into rows of fixed length by best fit decreasing
(operator 5).

Documents become segments of at most ``length`` tokens; a longer document is
cut into full rows and one rest, so nothing is lost.  Segments of a block go
in order of falling size into the open row with the least room that still
takes them.  The rows' capacities stand at the leaves of a segment tree over
room (how many rows have room r), so the best fit is one walk down the tree.

A block is what one task reads until ``block_tokens`` are together: packing
needs no shuffle, a task holds one block, and a lost executor repeats only its
own partitions.  Small file splits are read together, as many as fill a block,
so how full the rows get does not depend on the files.  Each row is written as a
little-endian id matrix row, the cumulative segment lengths and the positions,
which start anew in every segment; ``write_packed`` stores them and ``matrices``
gives an Arrow batch of them as numpy matrices.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import columns, id_text, small_batches

LENGTH = 2048
BLOCK_TOKENS = 4_000_000
# Bytes of text that give a token, roughly; more only makes fewer, larger tasks.
TOKEN_BYTES = 4
# Rows of a block handed to Spark at once.
ROWS = 512


class Rooms:
    """Open rows by the room they have left, in a segment tree: a node counts
    the rows of its range of rooms."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def _add(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, row) of a row with the least room >= need;
        of several the last one put there."""
        count, at = self.count, need + self.size
        if not count[at]:
            # Up to the first right sibling with rows, then down its left edge.
            while at > 1 and (at & 1 or not count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.size
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of segment numbers; equal sizes keep their order."""
    rooms, rows = Rooms(length), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = rooms.take(sizes[i])
        if found is None:
            room, row = length, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(i)
        if room > sizes[i]:
            rooms.put(room - sizes[i], row)
    return rows


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("packed", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


SCHEMA = pa.schema(
    [
        ("n_tokens", pa.int32()),
        ("ids", pa.binary()),
        ("positions", pa.binary()),
        ("cu_seqlens", pa.list_(pa.int32())),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_starts", pa.list_(pa.int64())),
    ]
)


def pack_block(segments: list[tuple[int, int, np.ndarray]], length: int, pad: int) -> Iterator[pa.RecordBatch]:
    """Rows of a block of (doc_id, start, ids)."""
    rows = best_fit_decreasing([len(ids) for _, _, ids in segments], length)
    for at in range(0, len(rows), ROWS):
        out: list[list] = [[] for _ in SCHEMA]
        for row in rows[at : at + ROWS]:
            own = [segments[i] for i in row]
            ends = np.cumsum([len(ids) for _, _, ids in own])
            matrix = np.full(length, pad, "<u2")
            places = np.zeros(length, "<u2")
            matrix[: ends[-1]] = np.concatenate([ids for _, _, ids in own])
            for end, (_, _, ids) in zip(ends.tolist(), own):
                places[end - len(ids) : end] = np.arange(len(ids))
            starts = [start for _, start, _ in own]
            values = (int(ends[-1]), matrix.tobytes(), places.tobytes(), [0, *ends.tolist()], [d for d, _, _ in own], starts)
            for column, value in zip(out, values):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, SCHEMA)], schema=SCHEMA)


def pack_documents(
    docs: DataFrame, path: str, pattern: str, length: int = LENGTH, pad: int = 50256, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """One row per packed row: pack_id, n_tokens (without padding), ids and
    positions (``length`` little-endian 16-bit numbers each; ``pad`` and 0 after
    the last token), cu_seqlens (0 and the end of each segment), doc_ids and
    doc_starts (each segment's document and its first token's place there).

    Whole texts; null and empty texts have no tokens and so no segment.
    Repeated rows are packed each on their own, a null doc_id stays null in
    doc_ids, other columns are left out.  ``length`` and ids below 65536.
    Which documents share a row follows the order of the stored files.
    """
    if not 0 < length < 1 << 16:
        raise ValueError("length must be between 1 and 65535")
    small_batches(docs.sparkSession)

    def run(source):
        bpe = encoder(path, pattern)
        segments, held = [], 0
        for batch in source:
            for doc_id, text in zip(*columns(batch, "doc_id", "text")):
                ids = np.array(bpe.encode_ordinary(text), "<u2")
                for start in range(0, len(ids), length):
                    segments.append((doc_id, start, ids[start : start + length]))
                held += len(ids)
                if held >= block_tokens:
                    yield from pack_block(segments, length, pad)
                    segments, held = [], 0
        yield from pack_block(segments, length, pad)

    ddl = "n_tokens int, ids binary, positions binary, cu_seqlens array<int>, doc_ids array<long>, doc_starts array<long>"
    texts = id_text(docs)
    held_bytes = texts.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    blocks = max(1, held_bytes // (TOKEN_BYTES * block_tokens))
    packed = texts.coalesce(blocks).mapInArrow(run, ddl)
    return packed.select(F.monotonically_increasing_id().alias("pack_id"), "*")


def write_packed(packed: DataFrame, path: str, length: int = LENGTH, pad: int = 50256) -> None:
    """Store packed rows below ``path``: ``rows`` (id matrix rows, positions and
    cumulative lengths, a part per task) and, written last, ``shape`` (one row:
    length, pad, rows, tokens, segments), so a set that was cut off has none."""
    packed.write.parquet(f"{path.rstrip('/')}/rows")
    stored = packed.sparkSession.read.schema(packed.schema).parquet(f"{path.rstrip('/')}/rows")
    shape = stored.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.size("doc_ids")), F.lit(0)).alias("segments"),
    )
    shape.select(F.lit(length).alias("length"), F.lit(pad).alias("pad"), "*").write.parquet(f"{path.rstrip('/')}/shape")


def read_packed(spark: SparkSession, path: str) -> tuple[DataFrame, Row]:
    """The stored rows and their shape; without a shape the read fails."""
    shape = spark.read.parquet(f"{path.rstrip('/')}/shape").first()
    return spark.read.parquet(f"{path.rstrip('/')}/rows"), shape


def matrices(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A batch of packed rows as (rows x length) ids and positions, and the
    (begin, end) of every segment in the flattened matrix, row by row."""
    column = lambda name: batch.column(batch.schema.get_field_index(name))
    ids, positions = (
        np.frombuffer(b"".join(column(name).to_pylist()), "<u2").reshape(batch.num_rows, length) for name in ("ids", "positions")
    )
    bounds = [(r * length + a, r * length + b) for r, ends in enumerate(column("cu_seqlens").to_pylist()) for a, b in zip(ends, ends[1:])]
    return ids, positions, np.array(bounds, np.int64).reshape(-1, 2)
