"""Removal of repeated byte windows by a depth-limited radix sort of suffixes
(operator 2).

Two windows of ``depth`` bytes are equal exactly if the suffixes that start
there are equal through ``depth`` bytes, so suffixes need ordering only that
deep.  Most-significant-digit passes do it: each pass groups the suffixes by
one more digit and drops those that stand alone, and the groups left after the
last digit are the repeated windows.

Not every suffix enters the sort.  An *anchor* is a position whose
``DIGIT``-byte string hashes lowest within some window; equal windows choose
the same anchor at the same place, so it is enough to sort the suffixes at
anchors (about one position in 70), read together with the bytes before them,
and to ask which windows around two equal anchors agree:

1. digit one, the anchor's ``DIGIT`` bytes: anchors that occur once go;
2. the anchor's whole surroundings (every window that contains it): where
   these are equal, all of its windows repeat, and one anchor stands for the
   class from here on;
3. for runs of 16, then 4, then 1 window starts the bytes that all windows of
   the run share: runs without company go.  Where all bytes that the run's
   windows cover have company, every window repeats and the run is settled;
   the others are cut into the next smaller runs, down to single windows of
   ``depth`` bytes.

Windows that contain an anchor form one run of bytes, so each pass leaves a
first and last start per anchor, and runs between these need not be cut.  Rows
are counted with partial aggregation before the shuffle, and a class of equal
bytes enters the next pass once, so a group of copies costs no more than its
own rows.  Anchors are compared by 62-bit polynomial hashes, everything later
by these together with 64 bits of another hash of the longer bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import Scratch, batches, columns, numbered, small_batches

DEPTH = 200
DIGIT = 64
RUNS = (16, 4, 1)
# Window starts handled at once: bounds the arrays for very long texts.
CHUNK = 1 << 17
_PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
_BASES = (911_382_323, 972_663_749)


def _powers(base: int, prime: int, size: int) -> np.ndarray:
    out = np.ones(size, np.uint64)
    have = 1
    while have < size:
        step = pow(base, have, prime)
        take = min(have, size - have)
        out[have : have + take] = out[:take] * np.uint64(step) % np.uint64(prime)
        have += take
    return out


class GramHash:
    """Hashes of all ``width``-byte strings of an array, the same for equal
    strings wherever they stand: 31 bits from each of two primes."""

    def __init__(self, width: int, size: int):
        self.width = width
        self.tables = [(_powers(b, p, size), np.uint64(p)) for b, p in zip(_BASES, _PRIMES)]

    def __call__(self, data: np.ndarray) -> np.ndarray:
        n = len(data) - self.width + 1
        out = np.zeros(n, np.uint64)
        wide = data.astype(np.uint64) + np.uint64(1)
        for powers, prime in self.tables:
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(wide * powers[: len(data)] % prime, out=sums[1:])
            # Place i carries the factor b^i; what is missing to b^(size-1) makes all places alike.
            own = (sums[self.width :] - sums[: -self.width]) % prime * powers[::-1][:n] % prime
            out = out << np.uint64(31) | own
        return out


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours (running minima from block ends)."""
    n = len(values)
    pad = -n % width
    top = np.full(pad, np.iinfo(np.uint64).max, np.uint64)
    blocks = np.concatenate([values, top]).reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def anchors(data: np.ndarray, depth: int, hasher: GramHash) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of all windows of ``data``: in each
    window the lowest hash, the leftmost of equals."""
    width = depth - hasher.width + 1
    low = np.uint64((1 << 18) - 1)
    places, found = [], []
    for at in range(0, len(data) - depth + 1, CHUNK):
        hashes = hasher(data[at : at + CHUNK + depth - 1])
        # Order by hash bits scrambled by a multiplication, then by place.
        order = hashes * np.uint64(0x9E3779B97F4A7C15) & ~low | np.arange(len(hashes), dtype=np.uint64)
        chosen = np.unique(_window_minima(order, width) & low).astype(np.int64)
        places.append(chosen + at)
        found.append(hashes[chosen])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(found)[first]


def _reach(at: int, size: int, depth: int, digit: int) -> tuple[int, int]:
    """The bytes that windows containing the anchor at ``at`` can cover."""
    return max(0, at - (depth - digit)), min(size, at + depth)


def _scan(depth: int, digit: int):
    schema = pa.schema([("row_id", pa.int64()), ("at", pa.int32()), ("digit", pa.int64()), ("around", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = GramHash(digit, CHUNK + depth)
        for batch in source:
            ids, ats, digits, arounds = [], [], [], []
            for row_id, text in zip(*columns(batch, "row_id", "text")):
                data = text.encode("utf-8", "surrogatepass")
                if len(data) < depth:
                    continue
                place, hashes = anchors(np.frombuffer(data, np.uint8), depth, hasher)
                ids.append(np.full(len(place), row_id, np.int64))
                ats.append(place.astype(np.int32))
                digits.append(hashes.view(np.int64))
                for at in place.tolist():
                    a, b = _reach(at, len(data), depth, digit)
                    own = hashlib.blake2b(data[a:b], digest_size=8, salt=(at - a).to_bytes(2, "little"))
                    arounds.append(own.digest())
            if ids:
                around = np.frombuffer(b"".join(arounds), np.int64)
                parts = [np.concatenate(ids), np.concatenate(ats), np.concatenate(digits), around]
                yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], schema=schema)

    return run


def _surroundings(depth: int, digit: int):
    """Rows (row_id, text, ats) to one row per anchor with its bytes."""
    fields = [("row_id", pa.int64()), ("at", pa.int32()), ("lead", pa.int32()), ("bytes", pa.binary())]
    schema = pa.schema(fields)

    def run(source):
        for batch in source:
            rows = []
            for row_id, text, ats in zip(*columns(batch, "row_id", "text", "ats")):
                data = text.encode("utf-8", "surrogatepass")
                for at in ats:
                    a, b = _reach(at, len(data), depth, digit)
                    rows.append((row_id, at, at - a, data[a:b]))
            yield from batches(rows, schema)

    return run


def _hashed(df: DataFrame) -> DataFrame:
    """The side of a join that holds each key once.  A task builds a table of
    its share of them, so the larger side (texts, anchors) need not be sorted."""
    return df.hint("shuffle_hash")


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def repeated_spans(docs: DataFrame, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): the numbered rows (row_id, doc_id, text) of ``docs``, and
    per row with a repeat its covered pieces (row_id, spans), not yet merged."""
    spark = docs.sparkSession
    small_batches(spark)
    digit = min(DIGIT, max(1, depth // 2))
    reach = depth - digit
    rows = numbered(docs)
    scratch = Scratch(spark, "suffix")

    # Pass 1: anchors by their first digit.
    found = scratch.write(
        rows.select("row_id", "text").mapInArrow(_scan(depth, digit), "row_id long, at int, digit long, around long"),
        "anchors",
    )
    shared = scratch.write(found.groupBy("digit").agg(F.count("*").alias("n")).where("n > 1").select("digit"), "digits")
    kept = scratch.write(found.join(_hashed(shared), "digit"), "kept")
    scratch.drop("anchors", "digits")

    # Pass 2: by everything around the anchor.
    classes = scratch.write(
        kept.groupBy("digit", "around").agg(F.count("*").alias("n"), F.min(F.struct("row_id", "at")).alias("one")), "classes"
    )
    whole = kept.join(_hashed(classes.where("n > 1").select("digit", "around")), ["digit", "around"])
    whole = whole.select("row_id", (F.col("at") - reach).alias("start"), (F.col("at") + depth).alias("stop"))
    several = classes.groupBy("digit").agg(F.count("*").alias("k")).where("k > 1").select("digit")
    partial = classes.join(several, "digit").select("digit", F.col("one.row_id").alias("row_id"), F.col("one.at").alias("at"))
    wanted = scratch.write(
        partial.groupBy("row_id").agg(F.collect_list("at").alias("ats")), "wanted"
    )  # a document's own anchors, so a list is bounded by its text
    scratch.drop()
    around = rows.select("row_id", "text").join(_hashed(wanted), "row_id").select("row_id", "text", "ats")
    around = around.mapInArrow(_surroundings(depth, digit), "row_id long, at int, lead int, bytes binary")
    around = scratch.write(around.withColumn("digit", F.xxhash64(F.expr(f"substring(bytes, lead + 1, {digit})"))), "around")
    scratch.drop("wanted")
    settled = _settle(around, scratch, depth, digit)
    parts = (
        settled.groupBy("row_id", "at")
        .agg(F.min("from_o").alias("low"), F.max("to_o").alias("high"))
        .select("row_id", (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + depth).alias("stop"))
    )
    spans = whole.unionByName(parts).groupBy("row_id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    spans = scratch.write(spans, "spans")
    scratch.drop("kept", "classes", "around", *[f"settled{run}" for run in RUNS])
    return rows, spans


def _settle(around: DataFrame, scratch: Scratch, depth: int, digit: int) -> DataFrame:
    """(row_id, at, from_o, to_o): runs of windows that all repeat, among them
    the outermost of each anchor.  A window starts o bytes before its anchor;
    o is valid where the window lies inside the text."""
    first, last = f"greatest(0, lead + {depth} - length(bytes))", f"least({depth - digit}, lead)"
    runs = around.selectExpr("row_id", "at", f"{first} AS from_o", f"{last} AS to_o")
    settled = None
    for run in RUNS:
        pieces = (
            around.join(runs, ["row_id", "at"])
            .select("*", F.explode(F.expr(f"sequence(from_o DIV {run}, to_o DIV {run})")).alias("run"))
            .withColumn("from_o", F.expr(f"greatest(from_o, run * {run})"))
            .withColumn("to_o", F.expr(f"least(to_o, run * {run} + {run - 1})"))
        )
        # Shared by the windows of the whole run, so by those that are valid here too.
        core = f"xxhash64(substring(bytes, lead + 1 - run * {run}, {depth - run + 1}))"
        cover = f"xxhash64(substring(bytes, lead + 1 - to_o, {depth} + to_o - from_o))"
        pieces = pieces.selectExpr("row_id", "at", "digit", "run", "from_o", "to_o", f"{core} AS core", f"{cover} AS cover")
        pieces = scratch.write(pieces, f"pieces{run}")
        group, same = ["digit", "run", "core"], ["digit", "from_o", "to_o", "cover"]
        company = pieces.groupBy(*group).agg(F.count("*").alias("n")).where("n > 1").drop("n")
        alive = scratch.write(pieces.join(_hashed(company), group), f"alive{run}")
        scratch.drop(f"pieces{run}")
        classes = alive.groupBy(*group, "from_o", "to_o", "cover").agg(
            F.count("*").alias("n"), F.min(F.struct("row_id", "at")).alias("one")
        )
        classes = scratch.write(classes, f"classes{run}")
        whole = alive.join(_hashed(classes.where("n > 1").select(*same).distinct()), same)
        whole = scratch.write(whole.select("row_id", "at", "from_o", "to_o"), f"settled{run}")
        settled = whole if settled is None else settled.unionByName(whole)
        if run > 1:
            # Single members that may widen what is known of their anchor call for a closer look at
            # their group; all its classes take part in that, each by one member.
            known = settled.groupBy("row_id", "at").agg(F.min("from_o").alias("low"), F.max("to_o").alias("high"))
            alone = classes.where("n = 1").select(*group, "one.row_id", "one.at", "from_o", "to_o")
            calls = (
                alone.join(known, ["row_id", "at"], "left")
                .where("low IS NULL OR from_o < low OR to_o > high")
                .select(*group)
                .distinct()
            )
            runs = scratch.write(
                classes.join(calls, group).select("one.row_id", "one.at", "from_o", "to_o"), f"runs{run}"
            )
        scratch.drop(f"alive{run}", f"classes{run}")
    scratch.drop(*[f"runs{run}" for run in RUNS])
    return settled


def remove_repeats(docs: DataFrame, depth: int = DEPTH, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row, and with
    ``with_text`` also kept (binary, the remaining bytes).

    Every byte covered by a ``depth``-byte string that also starts anywhere
    else goes, in the same text or another; texts are UTF-8 bytes, strings do
    not cross texts and are judged on the input.  A null text is empty; a text
    shorter than ``depth`` keeps all; repeated rows are copies of each other
    like any two equal texts; a null doc_id stays null.  Other columns of
    ``docs`` are left out.  ``docs`` must be a stored table.
    """
    rows, spans = repeated_spans(docs, depth)
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]
    schema = pa.schema([*fields, ("kept_sha256", pa.string()), *([("kept", pa.binary())] if with_text else [])])

    def run(source):
        for batch in source:
            out = []
            for doc_id, text, found in zip(*columns(batch, "doc_id", "text", "spans")):
                data = text.encode("utf-8", "surrogatepass")
                cut = _merge([(max(0, s["start"]), min(len(data), s["stop"])) for s in found or ()])
                edges = [0, *(x for span in cut for x in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                row = (doc_id, len(data), len(data) - len(kept), len(cut), hashlib.sha256(kept).hexdigest())
                out.append((*row, kept) if with_text else row)
            yield from batches(out, schema)

    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    joined = rows.join(_hashed(spans), "row_id", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, ddl + (", kept binary" if with_text else ""))
