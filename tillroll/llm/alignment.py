"""Alignment of two tokenizers' ids over the same bytes (operator 13).

Both tokenizers cut the bytes of " " + text.  Two dictionaries map the offset
at which a token ends to the token's index; the intersection of their keys, in
order, slices both id lists into groups that cover the same bytes, and every
slice gives the links of the tokens that end with it.

Neither tokenizer merges across the place where a character that is no white
space meets a space: the byte-level pattern never takes a space after another
character, and the other vocabulary has no piece with U+2581 after another
character (checked when it is loaded).  So a text is the list of its words, each
with the space before it; a word is encoded and aligned once and then looked
up.  Texts with words that end in white space, and all texts if the vocabulary
fails the check, are encoded and aligned whole.

Documents are encoded once and written with the ids of their links.  Counting
links over the corpus is a Spark aggregate over what tasks have counted.  The
counted pairs are broadcast while their number proves them small; beyond that
the documents' links meet them in a join.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tillroll.llm.bpe import byte_table
from tillroll.llm.common import Scratch, batches, columns, id_text, numbered, small_batches
from tillroll.llm.pieces import Pieces

# Counted pairs that may be broadcast: 24 bytes each, 96 MB at most.
BROADCAST_PAIRS = 4_000_000
# A hot pair stands in nearly every document; the join deals it to this many keys.
SALTS = 16
# Words remembered per worker, and encoded together as one text.
WORDS, JOINED = 350_000, 2000
# Pairs a task holds before it adds up equal ones.
HELD_PAIRS = 1_000_000
SPACE = "▁"


def slices(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """The offsets where both lists end a token, and for each the number of
    tokens of either list up to there; consecutive ones bound a group.  Tokens
    have a byte at least and the sizes' sums are equal."""
    a_ends = dict(zip(np.cumsum(a_sizes).tolist(), range(1, len(a_sizes) + 1)))
    b_ends = dict(zip(np.cumsum(b_sizes).tolist(), range(1, len(b_sizes) + 1)))
    common = sorted(a_ends.keys() & b_ends.keys())
    return common, [a_ends[end] for end in common], [b_ends[end] for end in common]


class Aligner:
    """Both tokenizers of a worker and the words they have met."""

    def __init__(self, a_path: str, b_path: str):
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        back = {c: b for b, c in byte_table().items()}
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        spelled = sorted(self.a.get_vocab(with_added_tokens=False).items(), key=lambda x: x[1])
        self.a_bytes = {i: bytes([back[c] for c in token]) for token, i in spelled}
        self.b_bytes = dict(
            enumerate(
                bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace(SPACE, " ").encode()
                for i, name in enumerate(names)
            )
        )
        if not all(self.a_bytes.values()) or not all(self.b_bytes.values()):
            raise ValueError("a vocabulary with an empty token cannot be aligned")
        self.a_size, self.b_size = self._sizes(self.a_bytes), self._sizes(self.b_bytes)
        self.a_name, self.b_name = ({i: str(i) for i in x} for x in (self.a_bytes, self.b_bytes))
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}", name) for name in names)
        # Per part: tokens of both, groups, links; the groups' spelling, the links' keys.
        self.words = Pieces(self._words, 4, 2, limit=WORDS)

    @staticmethod
    def _sizes(known: dict[int, bytes]) -> np.ndarray:
        sizes = np.zeros(max(known) + 1, np.int64)
        sizes[list(known)] = [len(b) for b in known.values()]
        return sizes

    def ids(self, text: str) -> tuple[list[int], list[int]]:
        """Both id lists of " " + text, empty where the bytes differ."""
        whole = " " + text
        data = whole.encode()
        a_ids = self.a.encode_batch_fast([whole], add_special_tokens=False)[0].ids
        if b"".join([self.a_bytes.get(i, b"") for i in a_ids]) != data:
            return [], []
        b_ids = self.b.encode(text, num_threads=1)
        return (a_ids, b_ids) if b"".join([self.b_bytes[i] for i in b_ids]) == data else ([], [])

    def aligned(self, a_ids: list[int], b_ids: list[int], ends: np.ndarray | None = None) -> tuple:
        """Numbers, groups' spelling and links' keys of every part of a text;
        the parts end at the byte offsets ``ends`` (None: one part), or there is
        no result if a token runs over such an end."""
        a_all, b_all = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        common, a_to, b_to = slices(self.a_size[a_all], self.b_size[b_all])
        if ends is None:
            ends = np.array(common[-1:] or [0])
        last = np.searchsorted(common, ends, "right")
        if a_ids and (np.array(common)[last - 1] != ends).any():
            return None
        bounds = np.concatenate([[0], last])
        n_groups = np.diff(bounds)
        n_a, n_b = (np.diff(np.array([0, *to])[bounds]) for to in (a_to, b_to))
        a_names, b_names = list(map(self.a_name.__getitem__, a_ids)), list(map(self.b_name.__getitem__, b_ids))
        groups = [
            f"{','.join(a_names[p:q])}|{','.join(b_names[r:s])}" for p, q, r, s in zip([0, *a_to], a_to, [0, *b_to], b_to)
        ]
        # One link per slice: tokens have bytes, so only the last of each list ends there.
        links = (a_all[np.array(a_to, int) - 1] << 32 | b_all[np.array(b_to, int) - 1]).tobytes()
        pairs = list(zip(bounds.tolist(), bounds[1:].tolist()))
        spelled = [";".join(groups[p:q]).encode() for p, q in pairs]
        return np.stack([n_a, n_b, n_groups, n_groups], 1), spelled, [links[8 * p : 8 * q] for p, q in pairs]

    def _words(self, words: list[str]) -> tuple[np.ndarray, list[list[bytes]]]:
        """Many words at once, as one text.  Without tokens: a word after which
        a text cannot be cut, or whose bytes differ."""
        numbers, values = np.zeros((len(words), 4), np.int64), ([b""] * len(words), [b""] * len(words))
        good = [i for i, word in enumerate(words) if word and not word[-1].isspace()]
        waiting = [good[k : k + JOINED] for k in range(0, len(good), JOINED)]
        while waiting:
            own = waiting.pop()
            texts = [words[i] for i in own]
            ids = self.ids(" ".join(texts))
            found = self.aligned(*ids, np.cumsum([1 + len(t.encode()) for t in texts])) if ids[0] else None
            if found:
                numbers[own] = found[0]
                for column, more in zip(values, found[1:]):
                    for i, value in zip(own, more):
                        column[i] = value
            elif len(own) > 1:
                half = len(own) // 2
                waiting += [own[:half], own[half:]]
        return numbers, list(values)

    def parts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
        """(places, ends, numbers, values): the places of all parts of all texts
        in the tables of numbers and values, and where each text ends among
        them.  A text's parts are its words, or the text itself where it must be
        taken whole; a text without tokens has none."""
        cut = [text.split(" ") if text and self.by_word else [] for text in texts]
        at, ends = self.words.slots(cut)
        numbers, values = self.words.numbers, self.words.values
        bad = np.concatenate([[0], np.cumsum(numbers[at, 0] == 0)])[np.concatenate([[0], ends])]
        whole = [n for n, text in enumerate(texts) if text and (not cut[n] or bad[n + 1] > bad[n])]
        if whole:
            start = len(self.words.slot)
            found = [self.aligned(*self.ids(texts[n])) for n in whole]
            numbers = np.concatenate([numbers[:start], *(f[0] for f in found)])
            values = [old + [f[1 + k][0] for f in found] for k, old in enumerate(values)]
            lists = np.split(at, ends[:-1])
            for k, n in enumerate(whole):
                lists[n] = np.array([start + k] if found[k][0][0, 0] else [], np.int64)
            at, ends = np.concatenate(lists), np.cumsum([len(x) for x in lists])
        return at, ends, numbers, values

    def trim(self) -> bool:
        full = self.words.full()
        if full:
            self.words.trim()
        return full


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core already
    return Aligner(a_path, b_path)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_ends, b_ends): the ids and, per group, the index
    after its last token in either list.

    One row per row; null and empty texts, and texts whose tokens do not give
    back their bytes in either vocabulary, have empty lists.  Repeated rows
    come out each, a null doc_id stays null, other columns are left out.
    """
    small_batches(docs.sparkSession)
    ints = pa.list_(pa.int32())
    schema = pa.schema([("doc_id", pa.int64()), ("a_ids", ints), ("b_ids", ints), ("a_ends", ints), ("b_ends", ints)])

    def run(source):
        own = aligner(a_path, b_path)
        for batch in source:
            rows = []
            for doc_id, text in zip(*columns(batch, "doc_id", "text")):
                a_ids, b_ids = own.ids(text) if text else ([], [])
                _, a_to, b_to = slices(own.a_size[np.array(a_ids, int)], own.b_size[np.array(b_ids, int)])
                rows.append((doc_id, a_ids, b_ids, a_to, b_to))
            yield from batches(rows, schema)

    ddl = "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>"
    return id_text(docs).mapInArrow(run, ddl)


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, pa.int32()))


def links(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of ``docs``: row_id, doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256, and a_links and b_links: the ids of every link in text
    order.  Texts without tokens have zeros and empty lists."""
    small_batches(docs.sparkSession)

    def run(source):
        own = aligner(a_path, b_path)
        for batch in source:
            own.trim()
            row_ids, doc_ids, texts = columns(batch, "row_id", "doc_id", "text")
            at, ends, numbers, values = own.parts(texts)
            bounds = np.concatenate([[0], ends])
            sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(numbers[at], 0)])[bounds]
            places = at.tolist()
            spell = values[0].__getitem__
            digests = [
                hashlib.sha256(b";".join(map(spell, places[p:q]))).hexdigest() if p < q else ""
                for p, q in zip(bounds.tolist(), ends.tolist())
            ]
            keys = np.frombuffer(b"".join(map(values[1].__getitem__, places)), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row_ids, pa.int64()), pa.array(doc_ids, pa.int64())]
                + [pa.array(column) for column in np.diff(sums, axis=0).T.copy()]
                + [pa.array(digests, pa.string()), _lists(keys >> 32, sums[1:, 3]), _lists(keys & 0xFFFFFFFF, sums[1:, 3])],
                names=["row_id", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a_links", "b_links"],
            )

    ddl = "row_id long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    return numbered(docs).mapInArrow(run, f"{ddl}, a_links array<int>, b_links array<int>")


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All links' keys of a batch, and where each row's end."""
    a, b = (batch.column(batch.schema.get_field_index(n)) for n in ("a_links", "b_links"))
    keys = a.flatten().to_numpy().astype(np.int64) << 32 | b.flatten().to_numpy()
    return keys, np.cumsum(a.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal keys added up."""
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)


def link_counts(linked: DataFrame) -> DataFrame:
    """(a_id, b_id, n, best) of :func:`links`: how many links of the corpus hold
    the pair, and whether no other pair of that B id has more.  An empty corpus
    has no rows."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def run(source):
        added = []
        for batch in source:
            keys, _ = _keys(batch)
            added.append(_added(keys, np.ones(len(keys))))
            if sum(len(k) for k, _ in added) > HELD_PAIRS:
                added = [_added(*map(np.concatenate, zip(*added)))]
        if added:
            keys, counts = _added(*map(np.concatenate, zip(*added)))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], schema=schema)

    counted = linked.select("a_links", "b_links").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    pairs = counted.select(
        F.shiftright("key", 32).cast("int").alias("a_id"), F.col("key").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id"), "n"
    )
    # A B id has at most as many rows here as the A vocabulary has ids.
    return pairs.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b_id")))


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _by_broadcast(linked: DataFrame, pairs: DataFrame) -> DataFrame:
    found = pairs.toArrow()
    keys = found["a_id"].to_numpy().astype(np.int64) << 32 | found["b_id"].to_numpy()
    order = np.argsort(keys)
    known = linked.sparkSession.sparkContext.broadcast(
        (keys[order], found["best"].to_numpy()[order].astype(np.int64), found["n"].to_numpy()[order])
    )
    plain = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(source):
        keys, *sizes = known.value
        for batch in source:
            own, ends = _keys(batch)
            at, bounds = np.searchsorted(keys, own), np.concatenate([[0], ends])
            sums = [np.diff(np.concatenate([[0], np.cumsum(x[at])])[bounds]) for x in sizes]
            kept = [batch.column(batch.schema.get_field_index(n)) for n in plain]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, sums)], names=[*plain, "n_best", "count_sum"])

    ddl = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return linked.mapInArrow(run, ddl)


def _by_join(linked: DataFrame, pairs: DataFrame) -> DataFrame:
    """For more pairs than may be broadcast: documents' links meet the counts
    in a join, a hot pair's on several keys."""
    each = (
        linked.select("row_id", F.explode(F.arrays_zip("a_links", "b_links")).alias("x"))
        .groupBy("row_id", F.col("x.a_links").alias("a_id"), F.col("x.b_links").alias("b_id"))
        .agg(F.count("*").alias("times"))
        .withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(SALTS)))
    )
    salted = pairs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    sums = (
        each.join(salted, ["a_id", "b_id", "salt"])
        .groupBy("row_id")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    )
    return linked.drop("a_links", "b_links").join(sums, "row_id", "left").na.fill(0, ["n_best", "count_sum"])


def align_digest(docs: DataFrame, a_path: str, b_path: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per document: doc_id, n_a and n_b (ids), n_groups, n_links, n_best (links
    whose pair is among the most frequent of its B id in the corpus), count_sum
    (the corpus counts of its links), groups_sha256 of its groups' ids.

    A link is a pair of token occurrences whose byte ranges end together.
    Texts that are null, empty, or not given back byte for byte by both
    vocabularies have zeros and an empty digest, and add nothing to the corpus
    counts.  One row per row, repeated rows (counted each) and null ids
    included; other columns are left out.  Up to ``broadcast_pairs`` different
    pairs are broadcast, more are joined.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    linked = scratch.write(links(docs, a_path, b_path), "links")
    pairs = scratch.write(link_counts(linked), "pairs")
    return (_by_broadcast if pairs.count() <= broadcast_pairs else _by_join)(linked, pairs).select(*COLUMNS)
