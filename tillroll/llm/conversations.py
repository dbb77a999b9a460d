"""Repair of conversation structure at least cost (operator 11).

A repaired conversation reads system?, then user and assistant by turns.  Rows
are kept (0), given the role that fits (1) or deleted (2, required for blank and
repeated ones); a row without text is inserted for 5; a truncated row that
stays adds 5.  The state is what came last: nothing, system, user, assistant.

A row's symbol is its role's initial and its fault.  Equal consecutive symbols
are one run.  A symbol's step is a 4 x 4 matrix over (min, +), its inserts
included; binary powers of every matrix are kept, so a run of any length costs
a few products.  Costs to go are found from the end, run by run, and the
choices unrolled from the start: of the cheapest the least in ASCII.

Rows are range partitioned by (conv_id, turn), so a conversation may lie in
many partitions and none must hold it whole.  Its part in a partition is a
matrix too; the first and last conversation of each partition (two rows a
partition, all that can be cut) give the driver what it needs to tell every
part its state at the start and its costs at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import Scratch, batches, checkpoint, columns, small_batches

WHITE = " \t\n\x0b\x0c\r"
NEVER = 1 << 60
STATES = range(4)  # nothing yet, system, user, assistant
NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
FITS = (2, 2, 3, 2)  # where an insert or a changed role leads
ROLE = {2: "user", 3: "assistant"}
ENDS = (0, 3)
DELETE, INSERT, KEEP, REROLE, TRUNCATED = 2, 5, 0, 1, 5
MUST_GO = "x"
# Longer runs are unrolled in halves, so that costs to go of few rows are held.
UNROLLED = 64
# Text of a cut conversation's part that travels in one row.
CHUNK = 1 << 20

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[p][r] + b[r][q] for r in STATES) for q in STATES) for p in STATES)


def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(a[p][q] + v[q] for q in STATES) for p in STATES)


def _inserts() -> Matrix:
    rows = []
    for p in STATES:
        costs, at = [NEVER] * 4, p
        for n in range(4):
            costs[at] = min(costs[at], n * INSERT)
            at = FITS[at]
        rows.append(tuple(costs))
    return tuple(rows)


INSERTS = _inserts()
UNIT: Matrix = tuple(tuple(0 if p == q else NEVER for q in STATES) for p in STATES)
# Costs to go where a conversation ends.
FINAL: Vector = tuple(min(INSERTS[p][q] for q in ENDS) for p in STATES)


def choices(symbol: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done with a row, by letter."""
    yield "D", DELETE, state
    if symbol != MUST_GO:
        extra = TRUNCATED if symbol.isupper() else 0
        to = NEXT.get(symbol.lower(), (None,) * 4)[state]
        if to is not None:
            yield "K", KEEP + extra, to
        yield "R", REROLE + extra, FITS[state]


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> Matrix:
    """2**k rows of a symbol."""
    if k:
        half = power(symbol, k - 1)
        return product(half, half)
    step = [[NEVER] * 4 for _ in STATES]
    for p in STATES:
        for _, cost, q in choices(symbol, p):
            step[p][q] = min(step[p][q], cost)
    return product(INSERTS, tuple(map(tuple, step)))


def run_vector(symbol: str, n: int, after: Vector) -> Vector:
    """Costs to go before a run of ``n`` rows."""
    k = 0
    while n:
        if n & 1:
            after = applied(power(symbol, k), after)
        n, k = n >> 1, k + 1
    return after


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(s, sum(1 for _ in same)) for s, same in groupby(symbols)]


def matrix(symbols: str) -> Matrix:
    out = UNIT
    for symbol, n in runs(symbols):
        k = 0
        while n:
            if n & 1:
                out = product(out, power(symbol, k))
            n, k = n >> 1, k + 1
    return out


def _unroll(symbol: str, n: int, state: int, after: Vector, out: list[str]) -> int:
    if n > UNROLLED:
        half = n // 2
        state = _unroll(symbol, half, state, run_vector(symbol, n - half, after), out)
        return _unroll(symbol, n - half, state, after, out)
    to_go = [after]
    for _ in range(n):
        to_go.append(applied(power(symbol, 0), to_go[-1]))
    for left in range(n, 0, -1):
        here, then, letters = to_go[left], to_go[left - 1], ""
        while True:
            ways = [(letter, q) for letter, cost, q in choices(symbol, state) if cost + then[q] == here[state]]
            if INSERT + here[FITS[state]] == here[state] and not (ways and ways[0][0] < "I"):
                letters, state = letters + "I", FITS[state]
                continue
            letter, state = ways[0]
            out.append(letters + letter)
            break
    return state


def unroll(symbols: str, state: int, after: Vector, ends: bool) -> tuple[list[str], int]:
    """Each row's edits (inserts before it, then what is done with it) and the
    state after them; a conversation that ``ends`` gets its last inserts as one
    more entry."""
    own = runs(symbols)
    to_go = [after]
    for symbol, n in reversed(own):
        to_go.append(run_vector(symbol, n, to_go[-1]))
    out: list[str] = []
    for (symbol, n), then in zip(own, to_go[-2::-1]):
        state = _unroll(symbol, n, state, then, out)
    if ends:
        letters = ""
        while state not in ENDS:
            letters, state = letters + "I", FITS[state]
        out.append(letters)
    return out, state


# Conversations repeat their patterns of symbols.
_short = lru_cache(maxsize=1 << 16)(unroll)


def edits_of(symbols: str, state: int, after: Vector, ends: bool) -> tuple[list[str], int]:
    return _short(symbols, state, after, ends) if len(symbols) <= 16 else unroll(symbols, state, after, ends)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, lost, copies) after planted faults, chosen by
    crc32 of "conv_id:turn" modulo 20 (0 lost, 1 emptied, 2 without ``.!?``,
    3 repeated, 4 from the user).  A null is one space in that key, in role and
    in text."""

    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.concat_ws(":", text_of("conv_id"), text_of("turn")).cast("binary")) % 20
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(code == 4, "user").otherwise(text_of("role")).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text")).alias("text"),
        (code == 0).alias("lost"),
        F.when(code == 3, 2).otherwise(1).alias("copies"),
    )


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the columns of :func:`damage`; nulls are one space."""
    return conversations.select(
        *[F.col(n).cast("long").alias(n) for n in ("conv_id", "turn")],
        *[F.coalesce(F.col(n), F.lit(" ")).alias(n) for n in ("role", "text")],
        F.lit(False).alias("lost"),
        F.lit(1).alias("copies"),
    )


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with their fault, range partitioned and sorted by conversation and
    turn.  Rows of one turn go by role, then by the digest of their text."""
    spark = rows.sparkSession
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    seen = rows.where(~F.col("lost")).groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("first"), F.max(turn).alias("last"))
    # Only what comes in several turns: what follows in the same turn stands next to it.
    again = seen.where(F.col("first") != F.col("last")).select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    end = F.substring(F.rtrim(F.col("text"), F.lit(WHITE)), -1, 1)
    named = rows.join(again, same, "left").select(
        "conv_id", "turn", "role", "text", "lost", "copies", "digest",
        (F.col("first") < turn).alias("later"),
        (end == "").alias("blank"),
        (~end.isin(".", "!", "?")).alias("cut"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["conv_id", "turn", "role", "digest"]
    return checkpoint(named.repartitionByRange(parts, *keys).sortWithinPartitions(*keys))


NARROW = ["block", "conv_id", "turn", "role", "lost", "copies", "digest", "later", "blank", "cut"]


def _rows(source: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """Rows as (conv_id, fault, symbol, the named columns): lost ones with no
    symbol, repeated ones twice."""
    before = None
    for batch in source:
        for own in zip(*columns(batch, *NARROW, *names)):
            block, conv_id, turn, role, lost, copies, digest, later, blank, cut = own[: len(NARROW)]
            values = (block, conv_id, turn, role, *own[len(NARROW) :])
            if lost:
                yield (*values, None, "")
                continue
            key = (conv_id, turn, role, digest)
            repeated = later or key == before
            before = key
            initial = role[:1] if role[:1] in NEXT else "o"
            for _ in range(copies):
                fault = "blank" if blank else "duplicate" if repeated else "truncated" if cut else None
                yield (*values, fault, MUST_GO if blank or repeated else initial.upper() if cut else initial)
                repeated = True


def _by_conversation(source: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple[bool, bool, int, int | None, list[tuple]]]:
    """(first, last, block, conv_id, rows) of each conversation in a partition."""
    groups = ((key, list(rows)) for key, rows in groupby(_rows(source, names), key=lambda r: r[:2]))
    held, first = next(groups, None), True
    while held:
        then = next(groups, None)
        yield first, then is None, *held[0], held[1]
        held, first = then, False


def _symbols(rows: list[tuple]) -> str:
    return "".join([r[-1] for r in rows])


def _chains(ordered: DataFrame) -> dict[tuple[int, bool], tuple[int, Vector, bool]]:
    """For the part of a cut conversation at the start (True) or end (False) of a
    block: its state before, its costs after, and whether it ends there."""
    numbers = [f"m{i}" for i in range(16)]
    schema = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("conv_id", pa.int64())] + [(n, pa.int64()) for n in numbers])

    def outer(source, value):
        rows = []
        for first, last, block, conv_id, own in _by_conversation(source, []):
            if first or last:
                place = 2 if first and last else 1 if last else 0
                rows.append((block, place, conv_id, *value(block, first, _symbols(own))))
        yield from batches(rows, schema)

    narrow = ordered.select(*NARROW)
    ddl = "block long, place int, conv_id long, " + ", ".join(f"{n} long" for n in numbers)

    def matrices(source):
        return outer(source, lambda block, first, symbols: [x for row in matrix(symbols) for x in row])

    # Two rows a partition at most.
    found = sorted(narrow.mapInArrow(matrices, ddl).collect(), key=lambda r: (r.block, r.place != 0, r.place))
    chains: list[list] = []
    for r in found:
        before = chains[-1][-1] if chains else None
        # Place 0 starts its block only, 1 ends it only, 2 is all of it.
        if before and before.place != 0 and r.place != 1 and before.conv_id == r.conv_id:
            chains[-1].append(r)
        else:
            chains.append([r])
    chains = [c for c in chains if len(c) > 1]
    if not chains:
        return {}
    after: dict[tuple[int, bool], Vector] = {}
    for chain in chains:
        costs = FINAL
        for r in reversed(chain):
            after[r.block, r.place != 1] = costs
            costs = applied(tuple(tuple(r[3 + 4 * p : 7 + 4 * p]) for p in STATES), costs)

    def states(source):
        def value(block, first, symbols):
            costs = after.get((block, first))
            if costs is None:
                return [0] * 16
            return [unroll(symbols, p, costs, False)[1] for p in STATES] + [0] * 12

        return outer(source, value)

    moved = {(r.block, r.place != 1): r[3:7] for r in narrow.mapInArrow(states, ddl).collect()}
    out = {}
    for chain in chains:
        state = 0
        for r in chain:
            key = (r.block, r.place != 1)
            out[key] = (state, after[key], r is chain[-1])
            state = moved[key][state]
    return out


OUT = [
    ("block", pa.int64()), ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
    ("fault", pa.string()), ("damaged", pa.bool_()), ("edits", pa.string()), ("state", pa.int32()), ("whole", pa.bool_()),
]


def repair(rows: DataFrame) -> DataFrame:
    """One row per row of ``rows`` (see :func:`damage`, :func:`undamaged`) in
    order, with its fault (null, blank, duplicate, truncated) and ``edits``: an
    I for every insert before it, then K, R or D; a row of no role ends each
    conversation with the inserts after its last row.  ``state`` is what came
    before the row's first edit.  Lost rows come with ``damaged`` true and no
    edits.  ``block`` numbers the partitions in order, ``whole`` is false for a
    conversation that lies in several.

    Turns go up with nulls first; a null conv_id is a conversation of its own.
    An empty table stays empty.
    """
    small_batches(rows.sparkSession)
    ordered = _ordered(rows).withColumn("block", F.spark_partition_id().cast("long"))
    chains = _chains(ordered)
    schema = pa.schema(OUT)

    def run(source):
        out = []
        for first, last, block, conv_id, own in _by_conversation(source, ["text"]):
            known = chains.get((block, first)) if first or last else None
            state, after, ends = known or (0, FINAL, True)
            edits, _ = edits_of(_symbols(own), state, after, ends)
            at = iter(edits)
            for _, _, turn, role, text, fault, symbol in own:
                letters = next(at) if symbol else None
                out.append((block, conv_id, turn, role, text, fault, not symbol, letters, state, known is None))
                for letter in letters or "":
                    state = moved(state, letter, role)
            if ends:
                out.append((block, conv_id, None, None, None, None, False, next(at), state, known is None))
            if len(out) > 256:
                yield from batches(out, schema)
                out = []
        yield from batches(out, schema)

    ddl = (
        "block long, conv_id long, turn long, role string, text string, fault string, damaged boolean, edits string, "
        "state int, whole boolean"
    )
    return ordered.select(*NARROW, "text").mapInArrow(run, ddl)


def moved(state: int, letter: str, role: str | None) -> int:
    return state if letter == "D" else NEXT[role[:1]][state] if letter == "K" else FITS[state]


def _repaired(rows: Iterable[tuple]) -> Iterator[str]:
    """``role:text`` of the repaired rows."""
    for role, text, edits, state in rows:
        for letter in edits or "":
            if letter == "K":
                yield f"{role}:{text}"
            elif letter != "D":
                yield f"{ROLE[FITS[state]]}:{text if letter == 'R' else ''}"
            state = moved(state, letter, role)


COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]
PRICE = {"D": DELETE, "I": INSERT, "K": KEEP, "R": REROLE}
LEGAL = {"su", "ua", "au"}


class Part:
    """What is known of a conversation's rows in one block."""

    def __init__(self):
        self.rows = 0
        self.turns = [None, None, 0]  # least, largest, different
        self.counts = dict.fromkeys(COUNTS, 0)
        self.initials: list[str | None] = [None, None]
        self.audit: list[str] = []

    def add(self, turn, role, fault, edits) -> None:
        self.audit.append(edits)
        self.counts["cost"] += sum(PRICE[letter] for letter in edits)
        if role is None:
            return
        if fault:
            self.counts[fault] += 1
            if fault == "truncated" and edits[-1] != "D":
                self.counts["cost"] += TRUNCATED
        if turn is not None:
            least, largest, n = self.turns
            self.turns = [turn if least is None else least, turn, n + (turn != largest)]
        initial = role[:1]
        if self.initials[1] is not None and self.initials[1] + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.initials = [initial if self.initials[0] is None else self.initials[0], initial]


PART = [
    ("conv_id", pa.int64()), ("block", pa.int64()), ("chunk", pa.int64()), ("whole", pa.bool_()),
    ("least", pa.int64()), ("largest", pa.int64()), ("n_turns", pa.int64()),
    *[(n, pa.int64()) for n in COUNTS], ("head", pa.string()), ("tail", pa.string()), ("audit", pa.string()), ("repaired", pa.binary()),
]
PART_DDL = (
    "conv_id long, block long, chunk long, whole boolean, least long, largest long, n_turns long, "
    + ", ".join(f"{n} long" for n in COUNTS)
    + ", head string, tail string, audit string, repaired binary"
)


def _parts(repaired: DataFrame) -> DataFrame:
    """Per conversation and block the sums, and the digest of the repaired rows;
    for cut conversations their text in its place, in chunks."""
    schema = pa.schema(PART)

    def run(source):
        names = ["conv_id", "block", "whole", "turn", "role", "text", "fault", "damaged", "edits", "state"]
        rows = (r for batch in source for r in zip(*columns(batch, *names)))
        out = []
        for (conv_id, block, whole), own in groupby(rows, key=lambda r: r[:3]):
            part, kept, n_chunks, held = Part(), [], 0, 0
            digest = hashlib.sha256()
            started = False
            for _, _, _, turn, role, text, fault, damaged, edits, state in own:
                if damaged:
                    continue
                part.add(turn, role, fault, edits)
                for line in _repaired([(role, text, edits, state)]):
                    data = line.encode()
                    if whole:
                        digest.update(b"\n" + data if started else data)
                        started = True
                    else:
                        kept.append(data)
                        held += len(data)
                if held > CHUNK:
                    out.append((conv_id, block, n_chunks, False, *[None] * 3, *[0] * 5, None, None, "", b"\n".join(kept) + b"\n"))
                    kept, held, n_chunks = [], 0, n_chunks + 1
            last = digest.hexdigest().encode() if whole else b"".join(x + b"\n" for x in kept)
            sums = [part.counts[n] for n in COUNTS]
            out.append((conv_id, block, n_chunks, whole, *part.turns, *sums, *part.initials, "".join(part.audit), last))
            if len(out) > 64:
                yield from batches(out, schema)
                out = []
        yield from batches(out, schema)

    return repaired.mapInArrow(run, PART_DDL)


RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
RESULT_DDL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _joined(parts: DataFrame) -> DataFrame:
    """The parts of cut conversations in order: at most two a block.  Only the
    digest needs a conversation's text in one place, a chunk at a time."""
    types = [pa.int64()] * 7 + [pa.string()] * 2
    schema = pa.schema(list(zip(RESULT, types)))

    def run(source):
        names = [n for n, _ in PART]
        rows = (dict(zip(names, r)) for batch in source for r in zip(*columns(batch, *names)))
        out = []
        for conv_id, own in groupby(rows, key=lambda r: r["conv_id"]):
            sums, audit, digest = dict.fromkeys(COUNTS, 0), [], hashlib.sha256()
            least = largest = tail = None
            n_turns, waiting = 0, b""
            for r in own:
                for n in COUNTS:
                    sums[n] += r[n]
                audit.append(r["audit"])
                if r["head"] is not None:
                    sums["illegal"] += tail is not None and tail + r["head"] not in LEGAL
                    tail = r["tail"]
                if r["least"] is not None:
                    n_turns += r["n_turns"] - (r["least"] == largest)
                    least, largest = r["least"] if least is None else least, r["largest"]
                if r["repaired"]:
                    digest.update(waiting + r["repaired"][:-1])
                    waiting = b"\n"
            gaps = 0 if least is None else largest - least + 1 - n_turns
            out.append((conv_id, gaps, *[sums[n] for n in COUNTS], "".join(audit), digest.hexdigest()))
        yield from batches(out, schema)

    order = ["conv_id", "block", "chunk"]
    return parts.where(~F.col("whole")).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, RESULT_DDL)


def repair_digest(rows: DataFrame) -> DataFrame:
    """Per conversation: gaps in its turns, its faults, ill-matched neighbours
    before repair, the least cost, the cheapest edits' letters, and the SHA-256
    of the repaired ``role:text`` lines.  See :func:`repair`; conversations whose
    rows are all lost have zeros, no edits and the empty digest."""
    parts = Scratch(rows.sparkSession, "conversations").write(_parts(repair(rows)), "parts")
    gaps = F.coalesce(F.col("largest") - F.col("least") + 1 - F.col("n_turns"), F.lit(0).cast("long"))
    whole = parts.where("whole").select("conv_id", gaps.alias("gaps"), *COUNTS, "audit", F.decode("repaired", "UTF-8").alias("repaired_sha256"))
    return whole.unionByName(_joined(parts))
