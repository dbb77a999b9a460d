"""SimHash near-duplicate groups by covering locality-sensitive hashing
(operator 6)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import batches, checkpoint, columns, numbered, small_batches, without_rows
from tillroll.llm.components import components

BITS = 64
# Shingles whose bits are counted at once, so that a very long text needs
# bounded memory beside its own bytes.
BLOCK = 1 << 14


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of a text: bit b is 1 if set in over half of the XXH64 of
    its word shingles.

    Words are runs of anything but U+0020 and U+0009-U+000D after A-Z became
    a-z; a text with fewer words than ``shingle`` is one shingle, a text
    without words has fingerprint 0.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, seed)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:n].tolist()
    stops = ends[shingle - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        hashes = np.array(
            [digest(joined[a:b], seed) for a, b in zip(starts[at : at + BLOCK], stops[at : at + BLOCK])], "<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(row_id, doc_id, fp) per row of ``docs``; fp is the fingerprint as a
    signed long."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(source):
        for batch in source:
            rows = [
                (r, d, int(np.uint64(fingerprint(t, shingle, seed)).view(np.int64)))
                for r, d, t in zip(*columns(batch, "row_id", "doc_id", "text"))
            ]
            yield from batches(rows, schema)

    return numbered(docs).mapInArrow(run, "row_id long, doc_id long, fp long")


def covering_masks(radius: int, fixed: int = 0) -> list[int]:
    """Bit masks such that two words that agree on ``fixed`` and differ in at
    most ``radius`` other bits agree on ``fixed`` and one whole mask.

    Every free bit gets a nonzero vector of ``radius + 1`` binary places, dealt
    in turn.  The mask of a nonzero vector v holds the bits whose vector has
    an odd product with v.  ``radius`` vectors cannot span the space, so some v
    is orthogonal to all differing bits, and its mask holds none of them.
    """
    size = 1 << (radius + 1)
    free = [b for b in range(BITS) if not fixed >> b & 1]
    vector = {b: i % (size - 1) + 1 for i, b in enumerate(free)}
    return [fixed | sum(1 << b for b in free if (vector[b] & v).bit_count() & 1) for v in range(1, size)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


# A bucket of more fingerprints is split by further masks, never compared pair by pair.
PAIRWISE = 64


def links(fps: DataFrame, radius: int) -> DataFrame:
    """(a, b): every pair of the distinct fingerprints ``fps`` (fp) that differ
    in at most ``radius`` bits, some of them more than once.

    Each level fixes the bits of a mask per table.  Buckets of up to
    ``PAIRWISE`` fingerprints are compared; larger ones go to the next level,
    where the bits still free are covered by masks of their own.  Each level
    leaves about half of the free bits, so after a few levels a bucket cannot
    hold more than ``PAIRWISE`` fingerprints: no bucket is cut and none grows
    with the corpus.
    """
    out, fixed = None, [0]
    pending = fps.select("fp", F.lit(0).cast("long").alias("fixed"))
    while True:
        # From the radius alone: 15 masks for radius 3, then 225, then 3375.
        paths = {f: list(dict.fromkeys(covering_masks(radius, f))) for f in fixed}
        keyed = _masked(pending, paths)
        keyed = keyed.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        sizes = (
            keyed.groupBy("mask", "key")
            .agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
            .where("n > 1")
        )
        sizes = checkpoint(sizes)
        members = checkpoint(keyed.join(sizes.where("n > 2").select("mask", "key", "n"), ["mask", "key"]))
        fixed = list(dict.fromkeys(m for ms in paths.values() for m in ms))
        last = max(BITS - m.bit_count() for m in fixed) <= PAIRWISE.bit_length() - 1
        near = members if last else members.where(F.col("n") <= PAIRWISE)
        grouped = near.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
        found = sizes.where("n = 2").select("a", "b").unionByName(grouped.mapInArrow(_close_pairs(radius), "a long, b long"))
        found = found.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
        out = found if out is None else out.unionByName(found)
        pending = members.where(F.col("n") > PAIRWISE).select("fp", F.col("mask").alias("fixed"))
        if last or pending.isEmpty():
            return out


def _masked(pending: DataFrame, paths: dict[int, list[int]]) -> DataFrame:
    """(fp, mask) for the masks that continue a row's ``fixed`` bits."""
    if len(paths) == 1:
        masks = F.array(*[F.lit(_signed(m)) for ms in paths.values() for m in ms])
        return pending.select("fp", F.explode(masks).alias("mask"))
    rows = [(_signed(f), [_signed(m) for m in ms]) for f, ms in paths.items()]
    table = pending.sparkSession.createDataFrame(rows, "fixed long, masks array<long>")  # 3375 rows at most for radius 3
    return pending.join(F.broadcast(table), "fixed").select("fp", F.explode("masks").alias("mask"))


def _close_pairs(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(source):
        for batch in source:
            rows = []
            for members in batch.column(0).to_pylist():
                words = np.array(members, np.int64)
                apart = np.bitwise_count((words[:, None] ^ words[None, :]).view(np.uint64))
                i, j = np.nonzero(np.triu(apart <= radius, 1))
                rows += zip(words[i].tolist(), words[j].tolist())
            yield from batches(rows, schema)

    return run


def _named(docs: DataFrame, shingle: int, max_bits: int, seed: int) -> DataFrame:
    """(row_id, doc_id, fp, first) per row; first is the (missing, doc_id,
    row_id) that comes first in the row's group, rows without a doc_id last."""
    prints = checkpoint(fingerprints(docs, shingle, seed))
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row_id")
    distinct = checkpoint(prints.groupBy("fp").agg(F.min(order).alias("low")))
    roots = components(links(distinct, max_bits))
    member = distinct.join(roots, distinct["fp"] == roots["vertex"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    first = member.groupBy("root").agg(F.min("low").alias("first"))
    named = member.join(first, "root").select(F.col("fp").alias("of"), "first")
    return prints.join(named, F.col("fp") == F.col("of")).drop("of")


def near_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    Fingerprints at ``max_bits`` or fewer differing bits are linked (equal
    ones too), and component_id is the smallest doc_id that links reach, the
    document's own included.  Only distinct fingerprints are hashed to buckets
    and linked, so a group of copies costs one row however large it is.

    A null text counts as empty; texts without words have fingerprint 0 and
    link like any other.  Repeated rows come out repeated; component_id is null
    only where no row of the group has a doc_id.  Other columns of ``docs`` are
    left out.  ``docs`` must be a stored table (rows are numbered as stored).
    """
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return _named(docs, shingle, max_bits, seed).select("doc_id", digits, F.col("first.doc_id").alias("component_id"))


def one_per_group(docs: DataFrame, shingle: int = 3, max_bits: int = 3, seed: int = 42) -> DataFrame:
    """``docs``, all columns, with exactly one row of each near-duplicate group:
    the one with the smallest doc_id, of rows that share it the first stored;
    rows without a doc_id only where the group has no other."""
    named = _named(docs, shingle, max_bits, seed)
    return without_rows(docs, named.where("row_id <> first.row_id"))
