"""Personal data by bootstrapped contextual extraction (operator 10).

Seeds are the entities that plain rules find (mail and IP addresses, payment
cards, telephone numbers) and tokens that look drawn at random (kind secret);
the latter are evidence only and count as found where a pattern says so.  The
word and the two words before a seed and after it, an end of the line counting
as a word, what is glued to its front (``password=``) and its own first letters
(vendors' key prefixes) are lexical patterns for its kind.  Patterns and the
identifier-like tokens they introduce form a graph; Spark scores it in rounds: a
pattern is as good as the instances it introduces, an instance as good as the
patterns that introduce it.  A pattern that introduces enough seeds, little
else, and hardly ever an ordinary word is trusted, and the identifiers it
introduces which no rule knows are found.  These are seeds of the next pass,
until a pass finds nothing new.  How often a pattern's words stand in the corpus
is counted once, for all passes.

The rules are linear: each match starts at a place from which nothing before
could have matched.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import Scratch, batches, columns, numbered, small_batches

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
FOUND = (*KINDS, SECRET)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

# A token is like an identifier with a digit or an @ in it and this many characters.
_TOKEN = re.compile(r"(?<!\S)\S*[0-9@]\S*")
SHORTEST = 5
# Neighbouring tokens are one identifier (030 1234 5678); more of them are a row of numbers.
JOINED = 12
BRACKETS = "()[]"
LINE = "\0"  # stands for a word at both ends of a line
GAP = "\t"  # the identifier's place in a pattern
HEAD = "\1"  # before the first letters of an identifier
HEAD_LETTERS = 4
EDGE = "\"'`.,;:!?()[]{}<>="
# A token that looks drawn at random: letters and digits, this many and so many of each.
_RANDOM = re.compile(r"[A-Za-z0-9]{16,}")
RANDOM_EACH = 4

_ZERO = {c: "0" for c in range(0x30, 0x3A)}
REACH = 120  # characters before and after an identifier first looked at for its patterns
MIN_SEEDS = 5
MIN_CONFIDENCE = 0.6
MIN_SPECIFIC = 0.5
ROUNDS = 3
# Slots of the bitmaps by which tasks know the words to count; a shared slot adds a row, not an error.
BITMAP_BITS = 22


def _emails(text: str) -> list[tuple[int, int]]:
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain:
            start = at
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((start, domain.end()))
                floor = domain.end()
                at = text.find("@", floor)
                continue
        at = text.find("@", at + 1)
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the rules' matches, in code points, by start, then
    kind.  Per kind the leftmost matches that do not overlap; a match that
    fails its check (parts over 255, digits, Luhn) is dropped."""
    spans = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in m.group().split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *m.span()))
    at = text.find("+")
    while at >= 0:
        m = _PHONE.match(text, at)
        if m and 9 <= len(_DIGITS.findall(m.group())) <= 15:
            spans.append(("phone", *m.span()))
        at = text.find("+", m.end() if m else at + 1)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def spell(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _plain(text: str) -> str:
    return text.lower().translate(_ZERO)


def _words(text: str) -> list[str]:
    """The words that patterns are made of: what is glued to a value by ``=``
    is one, and so are the ends of lines."""
    return f"{LINE} {_plain(text).replace('=', '= ').replace(chr(10), f' {LINE} ')} {LINE}".split()


def _before(text: str, start: int) -> list[str]:
    """The last two words before ``start`` on its line."""
    reach = REACH
    while True:
        low = max(0, start - reach)
        _, line, left = text[low:start].rpartition("\n")
        words = _words(left)[1:-1]
        if line or low == 0:
            return [LINE, *words][-2:]
        if len(words) > 2:  # the first may be the end of a word
            return words[-2:]
        reach *= 8


def _after(text: str, end: int) -> list[str]:
    reach = REACH
    while True:
        high = min(len(text), end + reach)
        right, line, _ = text[end:high].partition("\n")
        words = _words(right)[1:-1]
        if line or high == len(text):
            return [*words, LINE][:2]
        if len(words) > 2:
            return words[:2]
        reach *= 8


def _patterns(text: str, start: int, end: int) -> list[str]:
    """The patterns of a place: one and two words before it and after it on its
    line, digits as 0, and its own first letters.  Quotes and brackets on it are
    no words; a side on which its token goes on for ``REACH`` has none."""
    token = text[start : start + HEAD_LETTERS]
    low, high = max(0, start - REACH), min(len(text), end + REACH)
    while start > low and not text[start - 1].isspace() and text[start - 1] != "=":
        start -= 1
    while end < high and not text[end].isspace():
        end += 1
    out = []
    words = _before(text, start) if start > low or low == 0 else [LINE]
    if words and words[-1] != LINE:
        out.append(f"{words[-1]}{GAP}")
        if len(words) == 2:
            out.append(f"{' '.join(words)}{GAP}")
    words = _after(text, end) if end < high or high == len(text) else [LINE]
    if words and words[0] != LINE:
        out.append(f"{GAP}{words[0]}")
        if len(words) == 2:
            out.append(f"{GAP}{' '.join(words)}")
    if len(token) == HEAD_LETTERS and token.isalpha():
        out.append(f"{HEAD}{token.lower()}")
    return out


def _random(token: str) -> bool:
    digits = sum(c.isdigit() for c in token)
    return bool(_RANDOM.fullmatch(token)) and digits >= RANDOM_EACH and len(token) - digits >= RANDOM_EACH


def _tokens(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(start, end) of identifier-like tokens outside the places ``taken``.
    Neighbours on a line with one space and at most brackets between them are
    one, unless they hold an @ or are more than ``JOINED``."""
    runs: list[list[tuple[int, int]]] = []
    i, last = 0, -1  # last: where a token ended that the next one may join
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        glue = text.find("=", start, end)
        if glue > 0 and not _DIGITS.search(text, start, glue):
            start = glue + 1  # password=...
        while start < end and text[start] in EDGE:
            start += 1
        while end > start and text[end - 1] in EDGE:
            end -= 1
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if start == end or (i < len(taken) and taken[i][0] < end):
            last = -1
            continue
        plain = "@" not in m.group()
        near = plain and last >= 0 and m.start() == last + 1 and text[last] == " "
        if near and not text[m.start() : start].strip(BRACKETS):
            runs[-1].append((start, end))
        else:
            runs.append([(start, end)])
        last = m.end() if plain and not text[end : m.end()].strip(BRACKETS) else -1
    out = []
    for run in runs:
        out += [(run[0][0], run[-1][1])] if len(run) <= JOINED else run
    return [(a, b) for a, b in out if b - a >= SHORTEST]


def instances(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, str | None, int, int]]:
    """(pattern, instance, kind, start, end) of the seeds, and with kind null of
    the other identifier-like tokens."""
    others = _tokens(text, sorted((a, b) for _, a, b in spans))
    shaped = [(SECRET if _random(text[a:b]) else None, a, b) for a, b in others]
    return [(p, text[a:b].lower(), kind, a, b) for kind, a, b in (*spans, *shaped) for p in _patterns(text, a, b)]


def _slot(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) & ((1 << BITMAP_BITS) - 1)


def _counts(maps: list[list[int]]):
    """Counts of the words, pairs of neighbours and first letters whose slots
    are set, one row each per task.  ``maps`` are the bitmaps of the single words
    and first letters, and of the first and second words of pairs."""
    schema = pa.schema([("words", pa.string()), ("places", pa.int64())])

    def wanted(which: int, word: str) -> bool:
        slot = _slot(word)
        return bool(maps[which][slot >> 6] >> (slot & 63) & 1)

    def run(source):
        total: Counter = Counter()
        for batch in source:
            flat = [w for text in columns(batch, "text")[0] for w in _words(text)]
            index = {w: i for i, w in enumerate(dict.fromkeys(flat))}
            at = np.fromiter(map(index.__getitem__, flat), np.int64, len(flat))
            names = list(index)
            first, second = (np.fromiter((wanted(k, w) for w in names), bool, len(names)) for k in (1, 2))
            for word, n in zip(names, np.bincount(at, minlength=len(names)).tolist()):
                if wanted(0, word):
                    total[word] += n
                if len(word) >= HEAD_LETTERS and wanted(0, head := HEAD + word.lstrip(EDGE)[:HEAD_LETTERS]):
                    total[head] += n
            if len(at):
                for i in np.flatnonzero(first[at[:-1]] & second[at[1:]]).tolist():
                    total[f"{flat[i]} {flat[i + 1]}"] += 1
        yield from batches(list(total.items()), schema)

    return run


def _key(pattern: str = "pattern"):
    """What is counted in the corpus for a pattern."""
    return F.translate(pattern, GAP, "")


def places(rows: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """(pattern, places): how often the words of every pattern that introduces
    ``MIN_SEEDS`` different identifiers or more stand in the corpus."""
    known = found.groupBy("pattern").agg(F.countDistinct("instance").alias("n")).where(f"n >= {MIN_SEEDS}")
    known = scratch.write(known.select("pattern", _key().alias("words")), "known")
    two = F.split("words", " ")
    is_two = (F.size(two) == 2) & ~F.startswith("words", F.lit(HEAD))
    slot = lambda c: F.crc32(F.encode(c, "utf-8")).bitwiseAND((1 << BITMAP_BITS) - 1)
    wanted = F.when(is_two, F.array(F.struct(F.lit(1).alias("map"), slot(two[0]).alias("slot")), F.struct(F.lit(2).alias("map"), slot(two[1]).alias("slot"))))
    wanted = wanted.otherwise(F.array(F.struct(F.lit(0).alias("map"), slot(F.col("words")).alias("slot"))))
    slots = known.select(F.inline(wanted))
    words = slots.groupBy("map", F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits"))
    maps = np.zeros((3, 1 << (BITMAP_BITS - 6)), np.int64)  # the driver holds these, whatever the corpus
    for row in words.collect():
        maps[row.map, row.word] = row.bits
    counted = rows.select("text").mapInArrow(_counts(maps.view(np.uint64).tolist()), "words string, places long")
    counted = counted.groupBy("words").agg(F.sum("places").alias("places"))
    return scratch.write(known.join(counted, "words").select("pattern", "places"), "places")


def _candidates(found: DataFrame) -> DataFrame:
    """(pattern, kind, seeds): patterns of ``MIN_SEEDS`` different seeds or more
    and the kind of most of them."""
    seeds = found.where("kind IS NOT NULL").select("pattern", "kind", "instance").distinct()
    order = F.array_position(F.array(*[F.lit(k) for k in FOUND]), F.col("kind"))
    by_kind = seeds.groupBy("pattern", "kind").agg(F.count("*").alias("n"))
    best = F.max_by("kind", F.struct("n", -order)).alias("kind")
    return by_kind.groupBy("pattern").agg(F.sum("n").alias("seeds"), best).where(f"seeds >= {MIN_SEEDS}")


def _scored(places: DataFrame, found: DataFrame, scratch: Scratch, turn: int) -> tuple[DataFrame, DataFrame] | None:
    """((pattern, kind, score), (instance, score)) after ``ROUNDS`` rounds over
    the graph, or None where no pattern has enough seeds."""
    candidates = scratch.write(_candidates(found), f"candidates-{turn}")
    if candidates.isEmpty():
        return None
    edges = found.join(candidates.select("pattern"), "pattern").groupBy("pattern", "instance").agg(
        F.count("*").alias("n"), F.max(F.col("kind").isNotNull().cast("int")).alias("seed")
    )
    edges = scratch.write(edges, f"edges-{turn}")
    shape = edges.groupBy("pattern").agg(F.sum("n").alias("introduced"))
    specific = F.least(F.lit(1.0), F.col("introduced") / F.greatest("places", "introduced"))
    specific = scratch.write(
        shape.join(places, "pattern").select("pattern", specific.alias("specific")).where(f"specific >= {MIN_SPECIFIC}"), f"specific-{turn}"
    )
    edges = edges.join(specific, "pattern")
    known = edges.select("pattern", "instance", "specific", F.col("seed").cast("double").alias("belief"))
    for _ in range(ROUNDS):
        patterns = known.groupBy("pattern").agg((F.avg("belief") * F.first("specific")).alias("score"))
        linked = edges.join(patterns, "pattern")
        doubt = F.exp(F.sum(F.log(1 - F.least("score", F.lit(0.999)))))
        belief = F.when(F.max("seed") == 1, F.lit(1.0)).otherwise(1 - doubt)
        # The patterns of one place hold each other, so only those of one form count together.
        form = F.concat(F.instr("pattern", GAP) == 1, F.instr("pattern", " ") > 0).alias("form")
        beliefs = linked.groupBy("instance", form).agg(belief.alias("belief")).groupBy("instance").agg(F.max("belief").alias("belief"))
        known = edges.join(beliefs, "instance").select("pattern", "instance", "specific", "belief")
    good = patterns.where(F.col("score") >= MIN_CONFIDENCE).join(candidates.select("pattern", "kind"), "pattern")
    return scratch.write(good, f"patterns-{turn}"), scratch.write(beliefs, f"beliefs-{turn}")


def trusted(rows: DataFrame, found: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame] | None:
    """((pattern, kind, score), (instance, kind)) that are trusted once a pass
    with the instances of the last one as further seeds finds no new ones, or
    None where no pattern is trusted.  Instances of a rule are not among them."""
    found = found.withColumn("ruled", F.coalesce(F.col("kind").isin(*KINDS), F.lit(False)))
    stand = places(rows, found, scratch)
    seeds, many, turn, known = None, 0, 0, found
    while scored := _scored(stand, known, scratch, turn):
        patterns, beliefs = scored
        sure = beliefs.where(F.col("belief") >= MIN_CONFIDENCE).select("instance")
        new = found.where("NOT ruled").select("pattern", "instance").distinct().join(patterns, "pattern").join(sure, "instance")
        new = new.groupBy("instance").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
        if seeds is not None:
            new = new.join(seeds, "instance", "left_anti").unionByName(seeds)
        seeds = scratch.write(new, f"seeds-{turn}")
        if (now := seeds.count()) == many:
            break
        many, turn = now, turn + 1
        added = seeds.withColumnRenamed("kind", "as")
        known = found.join(added, "instance", "left").withColumn("kind", F.coalesce("kind", "as")).drop("as")
    return (patterns, seeds) if many else None


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row.

    Counts and base_sha256 are of the rules' matches, spans holds these and
    the ones that trusted patterns add (kind of the pattern, secret among them),
    by start, then kind.  Whole texts; a null or empty text has no spans; repeated rows come
    out repeated and count as evidence once per different instance; a null
    doc_id stays null; other columns are left out.  ``docs`` must be a stored
    table (rows are numbered as stored).
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "pii")
    rows = numbered(docs)
    span = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())])
    instance = pa.struct(
        [("pattern", pa.string()), ("instance", pa.string()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]
    )
    fields = [("row_id", pa.int64()), ("doc_id", pa.int64())]
    fields += [(f"n_{kind}", pa.int64()) for kind in KINDS]
    schema = pa.schema([*fields, ("base_sha256", pa.string()), ("base", pa.list_(span)), ("found", pa.list_(instance))])

    def run(source):
        names = [f.name for f in instance]
        for batch in source:
            out = []
            for row_id, doc_id, text in zip(*columns(batch, "row_id", "doc_id", "text")):
                spans = base_spans(text)
                counts = Counter(kind for kind, _, _ in spans)
                base = [{"start": a, "rank": KINDS.index(kind), "end": b} for kind, a, b in spans]
                around = [dict(zip(names, x)) for x in instances(text, spans)]
                digest = hashlib.sha256(spell(spans).encode()).hexdigest()
                out.append((row_id, doc_id, *[counts[k] for k in KINDS], digest, base, around))
            yield from batches(out, schema)

    ddl = (
        "row_id long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "base array<struct<start:int,rank:int,end:int>>, "
        "found array<struct<pattern:string,instance:string,kind:string,start:int,end:int>>"
    )
    marked = scratch.write(rows.select("row_id", "doc_id", "text").mapInArrow(run, ddl), "marked")
    found = marked.select("row_id", F.inline("found"))
    result = marked.select("row_id", "doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "base")
    if learned := trusted(rows, found, scratch):
        patterns, sure = learned
        rank = F.array_position(F.array(*[F.lit(k) for k in FOUND]), F.col("kind")).cast("int") - 1
        extra = (
            found.where(F.col("kind").isNull() | (F.col("kind") == SECRET))
            .drop("kind")
            .join(patterns, "pattern")
            .join(sure.select("instance"), "instance")
            .groupBy("row_id", "start", "end")
            .agg(F.max_by(rank, F.struct("score", "kind")).alias("rank"))
            .groupBy("row_id")
            .agg(F.collect_list(F.struct("start", "rank", "end")).alias("extra"))
        )
        result = result.join(extra, "row_id", "left")
    else:
        result = result.withColumn("extra", F.lit(None).cast("array<struct<start:int,rank:int,end:int>>"))
    names = f"array({', '.join(repr(k) for k in FOUND)})"
    every = "array_sort(concat(base, coalesce(extra, array())))"
    spelled = F.expr(f"array_join(transform({every}, s -> concat_ws(':', {names}[s.rank], s.start, s.end)), ',')")
    return result.select("doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", spelled.alias("spans"))
