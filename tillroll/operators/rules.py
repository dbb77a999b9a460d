"""Frequent itemsets and association rules.

With a length limit itemsets grow by levels over bitmaps of baskets; without,
they come from Spark ML's parallel FP-growth: transactions are split
into per-item-group conditional databases that are folded into FP-trees
map-side, so no basket pairs are ever materialised.  Rules grow from each
frequent itemset by levels: one-item consequents first, then one item more
where the smaller consequent met the confidence.  Confidence never rises as the
consequent grows, so what a level drops has no extension, and no itemset is
too long to expand.

Support boundaries follow ``count / n >= min_support`` exactly: FP-growth
is fitted a hair below the threshold (it rounds the minimum count up) and
the exact filter is applied afterwards.  All ratios are computed from the
integer counts in one fixed order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import itemset_text
from tillroll.operators.cubes import row_numbers
from tillroll.session import ensure_checkpoint_dir

METRIC_SCALE = 6
SUPPORT_MARGIN = 1e-9

# The reference's mining defaults and output texts.
DEFAULT_MIN_SUPPORT = 0.005
DEFAULT_MIN_CONFIDENCE = 0.1
DEFAULT_MIN_LIFT = 1.0
DEFAULT_TOP_N = 50
DEFAULT_THRESHOLDS = (0.005, 0.01, 0.02)
RULE_ARROW = " => "
RULE_SENTENCE = "Recommend %s when a basket contains %s (confidence=%.2f%%, lift=%.2f)."
BUNDLE_SENTENCE = "Bundle %s with %s for cross-sell."


def _positive(name: str, value: float | None) -> None:
    if value is not None and value <= 0:
        raise ValueError(f"{name} must be > 0")


def frequent_itemsets(
    baskets: DataFrame,
    min_support: float = DEFAULT_MIN_SUPPORT,
    max_len: int | None = None,
    num_partitions: int | None = None,
    checkpoint: bool = True,
) -> DataFrame:
    """M4: all itemsets with ``freq / n >= min_support`` (n = baskets), by
    FP-growth; with ``max_len`` those of at most so many items, by levels, so
    that no longer one is ever built.

    Columns: ``items`` (sorted array), ``size``, ``freq``, ``n``.  With
    ``checkpoint`` the baskets and the result are written to the reliable
    checkpoint folder: FP-growth reads its input several times and the
    rules read the itemsets three times, none of which should recompute
    the upstream shuffle after an executor loss.
    """
    _positive("min_support", min_support)
    if max_len is not None and max_len >= 1 and 0 < min_support <= 1:
        return itemsets_up_to(baskets, min_support, max_len)
    if min_support > 1:
        raise ValueError("min_support must be <= 1")
    if max_len is not None and max_len < 1:
        raise ValueError("max_len must be > 0")
    spark = baskets.sparkSession
    if checkpoint:
        ensure_checkpoint_dir(spark)
        # Equal and like baskets side by side (a hot one may fill several
        # partitions): each task's FP-trees then hold a share of the different
        # baskets and not nearly all of them, which is most of their cost.
        baskets = baskets.select("items").hint("rebalance", "items").checkpoint(eager=True)
    n = baskets.count()
    if n == 0:
        raise ValueError("no basket holds two different items, so there is nothing to mine")
    fp = FPGrowth(itemsCol="items", minSupport=min_support * (1 - SUPPORT_MARGIN), minConfidence=1.0)
    # Item groups are spread over at least the cluster's default parallelism
    # (AQE may have coalesced a small basket table into very few partitions).
    fp.setNumPartitions(
        num_partitions or max(spark.sparkContext.defaultParallelism, baskets.rdd.getNumPartitions())
    )
    found = fp.fit(baskets.select("items")).freqItemsets
    sets = found.select(
        F.array_sort("items").alias("items"),
        F.size("items").alias("size"),
        F.col("freq").cast("long").alias("freq"),
        F.lit(n).cast("long").alias("n"),
    ).where(F.col("freq") / F.col("n") >= F.lit(min_support))
    if checkpoint:
        sets = sets.checkpoint(eager=True)
    return sets


def itemsets_up_to(baskets: DataFrame, min_support: float, max_len: int) -> DataFrame:
    """The itemsets of at most ``max_len`` items, level by level.

    Every frequent item has bitmaps of the numbered baskets that hold it, 32 768
    baskets each.  A level's candidates are two frequent sets of the level
    before that differ in their last item, all of whose subsets are frequent;
    they are counted by and-ing their items' bitmaps, so baskets are read once.
    At most (average basket size / min_support) single items are frequent,
    which bounds the array that pairs are formed from.
    """
    spark = baskets.sparkSession
    ensure_checkpoint_dir(spark)
    placed = baskets.select(F.array_distinct("items").alias("items")).checkpoint()
    n = placed.count()
    if n == 0:
        raise ValueError("no basket holds two different items, so there is nothing to mine")
    enough = F.col("freq") / F.lit(n) >= F.lit(min_support)
    single = row_numbers(placed).select(F.explode("items").alias("item"), "number")
    frequent = single.groupBy("item").agg(F.count(F.lit(1)).alias("freq")).where(enough).checkpoint()
    maps = (
        single.join(frequent.select("item"), "item", "left_semi")
        .groupBy("item", F.bitmap_bucket_number("number").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
        .checkpoint()
    )
    level = frequent.select(F.array("item").alias("items"), "freq")
    found, size = level, 1
    while size < max_len:
        size += 1
        if size == 2:
            others = frequent.agg(F.array_sort(F.collect_list("item"))).scalar()
            later = frequent.select("item", others.alias("others")).select("item", F.explode(F.expr("filter(others, x -> x > item)")).alias("last"))
            candidates = later.select(F.array("item", "last").alias("items"))
        else:
            parts = level.select(F.slice("items", 1, size - 2).alias("head"), F.element_at("items", -1).alias("last"))
            pairs = parts.join(parts.withColumnRenamed("last", "next"), "head").where("next > last")
            candidates = pairs.select(F.concat("head", F.array("last", "next")).alias("items"))
            # A subset for each item left out; all of them must be frequent.
            without = F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: F.concat(F.slice("items", 1, i - 1), F.slice("items", i + 1, size)))
            subsets = candidates.select("items", F.explode(without).alias("subset"))
            held = subsets.join(level.select(F.col("items").alias("subset")), "subset", "left_semi")
            candidates = held.groupBy("items").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == size).select("items")
        each = candidates.select("items", F.explode("items").alias("item")).join(maps, "item")
        level = (
            each.groupBy("items", "bucket")
            .agg(F.count(F.lit(1)).alias("_n"), F.bitmap_count(F.bitmap_and_agg("bits")).alias("_baskets"))
            .where(F.col("_n") == size)
            .groupBy("items")
            .agg(F.sum("_baskets").alias("freq"))
            .where(enough)
            .checkpoint()
        )
        if level.isEmpty():
            break
        found = found.unionByName(level)
    return found.select("items", F.size("items").alias("size"), F.col("freq").cast("long").alias("freq"), F.lit(n).cast("long").alias("n"))


def itemsets_report(itemsets: DataFrame) -> DataFrame:
    """Printable itemsets: text, size, count and support."""
    return itemsets.select(
        itemset_text(F.col("items")).alias("itemset"),
        "size",
        "freq",
        F.round(F.col("freq") / F.col("n"), METRIC_SCALE).alias("support"),
    )


def association_rules(
    itemsets: DataFrame, min_confidence: float = DEFAULT_MIN_CONFIDENCE
) -> DataFrame:
    """M7: every (antecedent, consequent) split of every frequent itemset of
    two or more items with ``confidence >= min_confidence``.

    Columns: ``antecedent``, ``consequent`` (sorted arrays), ``support``,
    ``confidence``, ``lift``, ``antecedent_support``, ``consequent_support``
    (unrounded doubles) and the counts ``ac_freq``, ``a_freq``, ``c_freq``,
    ``n``.
    """
    _positive("min_confidence", min_confidence)
    ensure_checkpoint_dir(itemsets.sparkSession)
    counted = itemsets.select(F.col("items").alias("antecedent"), F.col("freq").alias("a_freq"))
    sets = itemsets.where("size >= 2").select("items", "size", F.col("freq").alias("ac_freq"), "n")
    # The last item of a consequent is the largest, so each consequent is reached once.
    grown = sets.select("*", F.expr("inline(transform(items, x -> struct(array(x) AS consequent)))"))
    splits = None
    while True:
        priced = (
            grown.withColumn("antecedent", F.array_except("items", "consequent"))
            .join(counted, "antecedent")
            .where(F.col("ac_freq") / F.col("a_freq") >= F.lit(min_confidence))
        )
        priced = priced.checkpoint(eager=True)
        splits = priced if splits is None else splits.unionByName(priced)
        longer = "filter(items, x -> x > element_at(consequent, -1))"
        grown = (
            priced.where(F.size("consequent") + 1 < F.col("size"))
            .select("items", "size", "ac_freq", "n", "consequent", F.explode(F.expr(longer)).alias("_next"))
            .select("items", "size", "ac_freq", "n", F.concat("consequent", F.array("_next")).alias("consequent"))
        )
        if grown.isEmpty():
            break
    c = itemsets.select(F.col("items").alias("consequent"), F.col("freq").alias("c_freq"))
    rules = splits.join(c, "consequent")
    confidence = F.col("ac_freq") / F.col("a_freq")
    return (
        rules.select(
            "antecedent",
            "consequent",
            (F.col("ac_freq") / F.col("n")).alias("support"),
            confidence.alias("confidence"),
            (confidence / (F.col("c_freq") / F.col("n"))).alias("lift"),
            (F.col("a_freq") / F.col("n")).alias("antecedent_support"),
            (F.col("c_freq") / F.col("n")).alias("consequent_support"),
            "ac_freq",
            "a_freq",
            "c_freq",
            "n",
        )
    )


def _rank_order() -> list[Column]:
    return [
        F.desc("lift"),
        F.desc("confidence"),
        F.desc("support"),
        F.asc("antecedents"),
        F.asc("consequents"),
    ]


def rule_text(rules: DataFrame) -> DataFrame:
    """M9: printable itemsets, ``A => C`` and the recommendation sentence.
    Percent/lift are rounded to 2 decimals before formatting."""
    a = itemset_text(F.col("antecedent"))
    c = itemset_text(F.col("consequent"))
    return rules.withColumn("antecedents", a).withColumn("consequents", c).select(
        "*",
        F.concat(F.col("antecedents"), F.lit(RULE_ARROW), F.col("consequents")).alias("rule_text"),
        F.format_string(
            RULE_SENTENCE,
            F.col("consequents"),
            F.col("antecedents"),
            F.round(F.col("confidence") * 100, 2),
            F.round(F.col("lift"), 2),
        ).alias("business_meaning"),
    )


def rank_rules(
    rules: DataFrame,
    min_lift: float = DEFAULT_MIN_LIFT,
    top_n: int | None = DEFAULT_TOP_N,
) -> DataFrame:
    """M8: ``lift >= min_lift``, by lift, confidence, support (desc), then
    the itemset texts; the first ``top_n`` (all when None).  Adds the M9
    text columns."""
    _positive("min_lift", min_lift)
    ranked = rule_text(rules.where(F.col("lift") >= F.lit(min_lift))).orderBy(*_rank_order())
    return ranked.limit(top_n) if top_n is not None else ranked


def rules_table(ranked: DataFrame) -> DataFrame:
    """The published rule table: 9 columns, metrics rounded to 6 decimals."""
    return ranked.select(
        "antecedents",
        "consequents",
        "rule_text",
        "business_meaning",
        *[
            F.round(m, METRIC_SCALE).alias(m)
            for m in ("support", "confidence", "lift", "antecedent_support", "consequent_support")
        ],
    )


def mine_rules(
    baskets: DataFrame,
    min_support: float = DEFAULT_MIN_SUPPORT,
    min_confidence: float = DEFAULT_MIN_CONFIDENCE,
    min_lift: float = DEFAULT_MIN_LIFT,
    max_len: int | None = None,
    top_n: int | None = DEFAULT_TOP_N,
) -> DataFrame:
    """M4 + M7 + M8 + M9 in one call: itemsets, rules, ranking and texts."""
    sets = frequent_itemsets(baskets, min_support, max_len)
    return rank_rules(association_rules(sets, min_confidence), min_lift, top_n)


def bundle_recommendations(ranked: DataFrame, text_rule: bool = True) -> DataFrame:
    """Rules with a single recommended product.

    ``text_rule=True`` keeps the reference behaviour (the consequent *text*
    has no comma, so a one-item consequent whose name has a comma is dropped
    too); ``False`` tests the item count instead.
    """
    single = (
        ~F.col("consequents").contains(",") if text_rule else F.size("consequent") == 1
    )
    return ranked.where(single).select(
        F.col("antecedents").alias("bundle_products"),
        F.col("consequents").alias("recommended_product"),
        F.round("support", METRIC_SCALE).alias("support"),
        F.round("confidence", METRIC_SCALE).alias("confidence"),
        F.round("lift", METRIC_SCALE).alias("lift"),
        F.format_string(BUNDLE_SENTENCE, F.col("antecedents"), F.col("consequents")).alias("recommendation"),
    )


def compare_thresholds(
    baskets: DataFrame,
    support_values: Sequence[float] = DEFAULT_THRESHOLDS,
    min_confidence: float = DEFAULT_MIN_CONFIDENCE,
    min_lift: float = DEFAULT_MIN_LIFT,
    max_len: int | None = None,
) -> DataFrame:
    """Rule count, max and mean lift per support threshold.

    Mines once at the lowest threshold: the rules at a higher threshold are
    exactly those with ``support >= t`` (confidence and lift do not depend
    on it).  One conditional aggregate pass then yields every row; a
    threshold without rules reports 0 / 0.0 / 0.0.
    """
    if not support_values:
        raise ValueError("at least one support value is required")
    for s in support_values:
        _positive("support value", s)
    sets = frequent_itemsets(baskets, min(support_values), max_len)
    rules = association_rules(sets, min_confidence).where(F.col("lift") >= F.lit(min_lift))
    return threshold_table(rules, support_values, min_confidence, min_lift)


def threshold_table(
    rules: DataFrame, support_values: Sequence[float], min_confidence: float, min_lift: float
) -> DataFrame:
    """One conditional-aggregate pass over the rules mined at the lowest
    threshold -> one row per threshold."""
    aggs = []
    for i, t in enumerate(support_values):
        hit = F.col("support") >= F.lit(t)
        aggs += [
            F.count_if(hit).alias(f"c{i}"),
            F.max(F.when(hit, F.col("lift"))).alias(f"mx{i}"),
            F.avg(F.when(hit, F.col("lift"))).alias(f"av{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("min_support"),
                F.lit(float(min_confidence)).alias("min_confidence"),
                F.lit(float(min_lift)).alias("min_lift"),
                F.col(f"c{i}").cast("long").alias("rule_count"),
                F.coalesce(F.round(f"mx{i}", METRIC_SCALE), F.lit(0.0)).alias("max_lift"),
                F.coalesce(F.round(f"av{i}", METRIC_SCALE), F.lit(0.0)).alias("avg_lift"),
            )
            for i, t in enumerate(support_values)
        ]
    )
    return rules.agg(*aggs).select(F.inline(rows))


def _finite(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) != F.lit(float("inf")))


def filter_rules(
    rules: DataFrame,
    min_support: float = float("-inf"),
    min_confidence: float = float("-inf"),
    min_lift: float = float("-inf"),
) -> DataFrame:
    """Rule explorer -- metrics at or above the chosen minimums, finite
    metrics only, highest lift first."""
    keep = (
        (F.col("support") >= F.lit(min_support))
        & (F.col("confidence") >= F.lit(min_confidence))
        & (F.col("lift") >= F.lit(min_lift))
        & _finite("support")
        & _finite("confidence")
        & _finite("lift")
    )
    return rules.where(keep).orderBy(F.desc("lift"), F.asc("antecedents"), F.asc("consequents"))


def metric_range(rules: DataFrame, metrics: Sequence[str] = ("support", "confidence", "lift")) -> DataFrame:
    """Min and max of each metric over finite values, one row per metric."""
    aggs = []
    for m in metrics:
        v = F.when(_finite(m), F.col(m))
        aggs += [F.min(v).alias(f"{m}__min"), F.max(v).alias(f"{m}__max")]
    wide = rules.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"{m}__min").cast("double").alias("min_value"),
                F.col(f"{m}__max").cast("double").alias("max_value"),
            )
            for m in metrics
        ]
    )
    return wide.select(F.inline(rows))


def melt_thresholds(thresholds: DataFrame, id_col: str = "min_support") -> DataFrame:
    """Wide threshold table -> (min_support, metric, value) rows over
    the numeric columns, values as DOUBLE."""
    numeric = [
        f.name
        for f in thresholds.schema.fields
        if f.name != id_col and f.dataType.typeName() in ("double", "long", "integer", "float")
    ]
    casted = thresholds.select(id_col, *[F.col(c).cast("double").alias(c) for c in numeric])
    return casted.unpivot([id_col], numeric, "metric", "value")
