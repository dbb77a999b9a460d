"""Benchmark decontamination by spaced-seed hashing (operator 4), DataFrame
functions only.

A document is contaminated by a benchmark item if some ``WINDOW`` consecutive
words of both, aligned word by word, agree in at least ``MATCHES`` places, so
single words may be replaced.  The masks below each hash ``WEIGHT`` selected
words of a short span and ignore the rest.  They are chosen so that wherever
the allowed substitutions fall in a window, at least one mask fits inside it
on agreeing words only: the join on hashes misses no such window, and counting
the agreeing words around a hit decides.

Items of fewer words are their own window: at least 0.8 of all their words must
agree, whichever these are; under five words that is all of them.  Such items
are reported like the others, but too common a text to drop a document for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import numbered, without_rows

WINDOW = 12
MATCHES = 10
SHORTEST = 5  # words of an item that a document is dropped for
NEAR = WINDOW - 1  # words on either side of a hit that its windows can reach
# Selected word positions.  Any two substitutions in 12 words leave one of the
# three on agreeing words.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 5, 6, 7), (0, 1, 2, 5, 8, 9))
# The same for items of fewer words and a fifth of them replaced, rounded down.
SHORT_MASKS = {1: ((0,),), 2: ((0, 1),), 5: ((0, 1, 2), (0, 1, 3, 4))} | {m: ((0, 1, 2),) for m in (3, 4, *range(6, WINDOW))}

# Seeds of the benchmark (60 bytes each, whatever the item's length) and bytes of its
# words that are broadcast; a larger benchmark is shuffled.
BROADCAST_SEEDS = 500_000
BROADCAST_BYTES = 64 << 20
WORD_BYTES = 24  # of a word in an array, beside its characters


def words_of(text: str) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.expr(rf"array_remove(split(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), '')")


def _seed(k: int, mask: tuple[int, ...]) -> str:
    picked = ", ".join(f"get(words, at + {i})" for i in mask)
    return f"CASE WHEN at + {mask[-1]} < n THEN xxhash64({k}, {picked}) END"


def _seeds(rows: DataFrame, masks: list[tuple[int, tuple[int, ...]]], *keep: str) -> DataFrame:
    """A row per word position and mask: the columns ``keep``, at, seed."""
    placed = rows.where("n > 0").select(*keep, "words", "n", F.explode(F.expr("sequence(0, n - 1)")).alias("at"))
    seeds = F.expr(f"array({', '.join(_seed(k, m) for k, m in masks)})")
    names = dict.fromkeys([*keep, "at"])
    return placed.select(*names, F.explode(seeds).alias("seed")).where("seed IS NOT NULL")


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_id, key, item, m, bytes) per different item that has words; the key
    is the digest of its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text"))
        .distinct()
        .select("item_id", F.unhex(F.sha2("text", 256)).alias("key"), words_of("text").alias("item"), F.octet_length("text").alias("bytes"))
        .withColumn("m", F.size("item"))
        .where("m > 0")
    )


def _near(words: str, at: str) -> tuple[Column, Column]:
    """The words that windows over a hit can reach, and the hit's place in them."""
    first = f"greatest({at} - {NEAR}, 0)"
    return F.expr(f"slice({words}, {first} + 1, {at} - {first} + {NEAR} + 1)"), F.expr(f"{at} - {first}")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row_id, doc_id, item_id, doc_at, item_at, n_words, n_equal): every
    aligned window that meets the rule, once.

    Whole texts and the whole benchmark; null texts count as empty and match
    nothing.  ``row_id`` numbers the rows of ``docs`` as stored, so repeated
    rows are found each on their own; a null doc_id or item_id is carried
    along (null items count as one).  Other columns are left out.
    """
    rows = numbered(docs).select("row_id", "doc_id", words_of("text").alias("words"))
    rows = rows.withColumn("n", F.size("words"))
    items = _items(benchmark)
    # Of the twelve lengths (the last one: a window or more) those that occur.
    length = F.least("m", F.lit(WINDOW))
    sizes = items.groupBy(length.alias("length")).agg(
        F.sum("m").alias("words"), F.sum(F.col("bytes") + WORD_BYTES * F.col("m")).alias("bytes")
    )
    found = {r.length: r for r in sizes.collect()}
    by_length = {m: SHORT_MASKS.get(m, MASKS) for m in sorted(found) or [WINDOW]}
    masks = list(enumerate(sorted({mask for some in by_length.values() for mask in some})))
    texts, item_seeds = items.select("key", F.col("item").alias("words"), F.col("m").alias("n"), length.alias("length")), None
    for m, some in by_length.items():
        seeds = _seeds(texts.where(F.col("length") == m), [(k, mask) for k, mask in masks if mask in some], "key")
        item_seeds = seeds if item_seeds is None else item_seeds.unionByName(seeds)
    item_seeds = item_seeds.select("seed", "key", F.col("at").alias("item_at")).distinct()
    doc_seeds = _seeds(rows, masks, "row_id", "doc_id", "words", "n")
    item_words = items.select("item_id", "key", "item", "m")
    few_seeds = sum(len(by_length[m]) * r.words for m, r in found.items()) <= BROADCAST_SEEDS
    few_words = sum(r.bytes for r in found.values()) <= BROADCAST_BYTES
    item_seeds = F.broadcast(item_seeds) if few_seeds else item_seeds
    item_words = F.broadcast(item_words) if few_words else item_words
    item_near, item_hit = _near("item", "item_at")
    doc_near, doc_hit = _near("words", "at")
    item_part = [item_near.alias("item_near"), item_hit.alias("item_hit")]
    doc_part = [doc_near.alias("doc_near"), doc_hit.alias("doc_hit")]
    if few_seeds and few_words:
        hits = doc_seeds.join(item_seeds, "seed").join(item_words, "key")
        hits = hits.select("row_id", "doc_id", "at", "item_id", "m", "item_at", *item_part, *doc_part)
    else:  # neither text travels with the seeds
        hits = doc_seeds.select("row_id", "at", "seed").join(item_seeds, "seed").join(item_words, "key")
        hits = hits.select("row_id", "at", "item_id", "m", "item_at", *item_part).join(rows, "row_id")
        hits = hits.select("row_id", "doc_id", "at", "item_id", "m", "item_at", "item_near", "item_hit", *doc_part)
    # Every window that holds the two positions of a hit, as (doc_at, item_at).
    size = f"least(m, {WINDOW})"
    shifts = F.expr(
        f"filter(sequence(0, {size} - 1), s -> doc_hit >= s AND item_hit >= s"
        f" AND doc_hit - s + {size} <= size(doc_near) AND item_hit - s + {size} <= size(item_near))"
    )
    windows = hits.select("*", F.explode(shifts).alias("s"))
    equal = f"size(filter(sequence(0, {size} - 1), i -> doc_near[doc_hit - s + i] = item_near[item_hit - s + i]))"
    return (
        windows.select(
            "row_id",
            "doc_id",
            "item_id",
            F.expr("at - s").alias("doc_at"),
            F.expr("item_at - s").alias("item_at"),
            F.expr(size).alias("n_words"),
            F.expr(equal).alias("n_equal"),
        )
        .where(f"n_equal >= CASE WHEN n_words < {WINDOW} THEN ceil(0.8 * n_words) ELSE {MATCHES} END")
        .distinct()
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document row and benchmark item with an overlap: doc_id, item_id,
    n_windows, best_equal (words that agree in the best window), first_word and
    last_word (of all windows, in the document's word positions)."""
    return (
        overlaps(docs, benchmark)
        .groupBy("row_id", "doc_id", "item_id")
        .agg(
            F.count("*").alias("n_windows"),
            F.max("n_equal").alias("best_equal"),
            F.min("doc_at").alias("first_word"),
            F.max(F.col("doc_at") + F.col("n_words") - 1).alias("last_word"),
        )
        .drop("row_id")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """``docs``, all columns, without the rows that overlap a benchmark item of
    ``shortest`` words or more: a shorter one is found in too much clean text."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    items = benchmark.select("item_id", text).where(F.size(words_of("text")) >= shortest)
    return without_rows(docs, overlaps(docs, items).select("row_id").distinct())
