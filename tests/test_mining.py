"""F2-F5 and a brute-force cross-check of itemsets and rules."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tillroll.operators import baskets as bk
from tillroll.operators import rules as rl


def _items(spark, rows):
    return spark.createDataFrame(rows, "order_id_nk string, product_name string")


def _baskets_of(spark, baskets):
    rows = [(str(i), item) for i, b in enumerate(baskets) for item in b]
    return bk.baskets(_items(spark, rows))


def test_f2_basket_build(spark):
    b = bk.baskets(_items(spark, [("1", "Bread"), ("1", "Milk"), ("2", "Bread"), ("2", "Eggs")]))
    got = sorted((r.order_id_nk, tuple(r.items)) for r in b.collect())
    assert got == [("1", ("Bread", "Milk")), ("2", ("Bread", "Eggs"))]
    distinct_items = b.select(F.explode("items")).distinct().count()
    assert distinct_items == 3


def test_baskets_drop_null_blank_and_single_items(spark):
    rows = [("1", " Bread "), ("1", "Bread"), ("1", "\t"), ("1", None), ("2", "Milk"), (None, "Eggs"), ("3", "A"), ("3", "B")]
    got = sorted((r.order_id_nk, tuple(r.items)) for r in bk.baskets(_items(spark, rows)).collect())
    assert got == [("3", ("A", "B"))]


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError, match="the frame lacks"):
        bk.baskets(spark.createDataFrame([("1",)], "order_id_nk string"))


def test_f3_summary(spark):
    items = spark.createDataFrame(
        [("1", "Bread", "Bakery", True), ("1", "Milk", "Dairy", False), ("2", "Bread", "Bakery", True)],
        "order_id_nk string, product_name string, department_name string, reordered boolean",
    )
    s = {(r.section, r.metric, r.label): r.value for r in bk.summarize_baskets(items).collect()}
    assert s[("overall", "order_product_rows", "all")] == 3
    assert s[("overall", "basket_count", "all")] == 2
    assert s[("overall", "unique_products", "all")] == 2
    assert s[("overall", "avg_basket_size", "all")] == 1.5
    assert s[("overall", "median_basket_size", "all")] == 1.5
    assert s[("overall", "max_basket_size", "all")] == 2
    assert s[("overall", "reordered_rate", "all")] == 0.6667
    assert s[("top_product", "line_count", "Bread")] == 2
    assert s[("top_department", "line_count", "Bakery")] == 2
    assert ("top_aisle", "line_count", "Bakery") not in s


F4 = [{"Bread", "Milk"}, {"Bread", "Milk"}, {"Bread", "Eggs"}, {"Milk", "Eggs"}]


def test_f4_rules(spark):
    b = _baskets_of(spark, F4)
    ranked = rl.mine_rules(b, min_support=0.25, min_confidence=0.5, min_lift=0.1, top_n=None)
    got = [(r.antecedents, r.consequents, round(r.support, 6), round(r.confidence, 6), round(r.lift, 6)) for r in ranked.collect()]
    assert got == [
        ("Bread", "Milk", 0.5, 0.666667, 0.888889),
        ("Milk", "Bread", 0.5, 0.666667, 0.888889),
        ("Eggs", "Bread", 0.25, 0.5, 0.666667),
        ("Eggs", "Milk", 0.25, 0.5, 0.666667),
    ]
    text = ranked.first()
    assert text.rule_text == "Bread => Milk"
    assert text.business_meaning == "Recommend Milk when a basket contains Bread (confidence=66.67%, lift=0.89)."


def test_f4_thresholds(spark):
    b = _baskets_of(spark, F4)
    t = rl.compare_thresholds(b, [0.25, 0.5], min_confidence=0.5, min_lift=0.1)
    got = [(r.min_support, r.rule_count, r.max_lift, r.avg_lift) for r in t.orderBy("min_support").collect()]
    assert got == [(0.25, 4, 0.888889, 0.777778), (0.5, 2, 0.888889, 0.888889)]
    melted = rl.melt_thresholds(t)
    assert melted.count() == 2 * 5 and set(melted.columns) == {"min_support", "metric", "value"}


def test_threshold_without_rules_reports_zero(spark):
    b = _baskets_of(spark, F4)
    t = rl.compare_thresholds(b, [0.25, 0.9], min_confidence=0.5, min_lift=0.1)
    r = t.where(F.col("min_support") == 0.9).first()
    assert (r.rule_count, r.max_lift, r.avg_lift) == (0, 0.0, 0.0)


def test_f5_bundles(spark):
    ranked = spark.createDataFrame(
        [("Bread", "Milk", 0.5, 0.8, 1.2), ("Bread", "Milk, Eggs", 0.25, 0.5, 1.1)],
        "antecedents string, consequents string, support double, confidence double, lift double",
    )
    b = rl.bundle_recommendations(ranked).collect()
    assert [(r.bundle_products, r.recommended_product, r.recommendation) for r in b] == [
        ("Bread", "Milk", "Bundle Bread with Milk for cross-sell.")
    ]


def test_support_exactly_on_threshold_is_kept(spark):
    # 7 of 100 baskets hold {A, B}: support .07 must survive a .07 threshold.
    baskets = [{"A", "B"}] * 7 + [{"C", "D"}] * 93
    sets = rl.frequent_itemsets(_baskets_of(spark, baskets), 0.07)
    got = {tuple(r.items): r.freq for r in sets.collect()}
    assert got[("A", "B")] == 7 and got[("A",)] == 7


def test_multi_item_consequents(spark):
    b = _baskets_of(spark, [{"A", "B", "C"}] * 3 + [{"A", "B"}])
    rules = rl.association_rules(rl.frequent_itemsets(b, 0.5), 0.1)
    cons = {(tuple(r.antecedent), tuple(r.consequent)) for r in rules.collect()}
    assert (("A",), ("B", "C")) in cons and (("A", "B"), ("C",)) in cons
    assert len(cons) == 12


def _brute(baskets, s, conf, max_len):
    n = len(baskets)
    counts = {}
    for b in baskets:
        for k in range(1, min(len(b), max_len) + 1):
            for c in itertools.combinations(sorted(b), k):
                counts[c] = counts.get(c, 0) + 1
    freq = {k: v for k, v in counts.items() if v / n >= s}
    rules = {}
    for z, f in freq.items():
        if len(z) < 2:
            continue
        for k in range(1, len(z)):
            for a in itertools.combinations(z, k):
                c = tuple(x for x in z if x not in a)
                confidence = f / freq[a]
                if confidence >= conf:
                    rules[(a, c)] = (f / n, confidence, confidence / (freq[c] / n))
    return freq, rules


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    items = list("ABCDEFG")
    baskets = [set(rnd.sample(items, rnd.randint(2, 5))) for _ in range(rnd.randint(30, 80))]
    s, conf = rnd.choice([0.05, 0.1, 0.2]), 0.3
    freq, expected = _brute(baskets, s, conf, 7)
    b = _baskets_of(spark, baskets)
    sets = rl.frequent_itemsets(b, s)
    assert {tuple(r.items): r.freq for r in sets.collect()} == freq
    got = {
        (tuple(r.antecedent), tuple(r.consequent)): (r.support, r.confidence, r.lift)
        for r in rl.association_rules(sets, conf).collect()
    }
    assert got.keys() == expected.keys()
    for k, v in expected.items():
        assert got[k] == pytest.approx(v)
    # anti-monotonicity: no superset is more frequent than its subsets
    for z, f in freq.items():
        for k in range(1, len(z)):
            for a in itertools.combinations(z, k):
                assert freq[a] >= f


def test_metric_range_ignores_infinite(spark):
    df = spark.createDataFrame(
        [(0.1, 0.5, float("inf")), (0.2, 0.4, 2.0), (None, 0.3, 1.0)], "support double, confidence double, lift double"
    )
    r = {x.metric: (x.min_value, x.max_value) for x in rl.metric_range(df).collect()}
    assert r == {"support": (0.1, 0.2), "confidence": (0.3, 0.5), "lift": (1.0, 2.0)}


def test_invalid_parameters(spark):
    b = _baskets_of(spark, F4)
    with pytest.raises(ValueError):
        rl.frequent_itemsets(b, 0)
    with pytest.raises(ValueError):
        rl.compare_thresholds(b, [])


def test_long_itemsets_expand_where_confidence_prunes(spark):
    # One set of 34 items in a fiftieth of the baskets that hold its items: 2^34 splits, few confident.
    items = [f"i{n:02d}" for n in range(34)]
    rows = [(items, 34, 10, 1000)]
    rows += [([i], 1, 500, 1000) for i in items]
    rows += [(items[:k] + items[k + 1 :], 33, 10 if k == 3 else 400, 1000) for k in range(34)]
    sets = spark.createDataFrame(rows, "items array<string>, size int, freq long, n long")
    found = rl.association_rules(sets.where("size <> 33 OR freq = 10"), 0.5).collect()
    assert [(tuple(r.antecedent), tuple(r.consequent)) for r in found] == [
        (tuple(items[:3] + items[4:]), (items[3],))
    ]


def test_levels_equal_fp_growth_up_to_the_length(spark):
    rng = random.Random(11)
    rows = [([f"i{i}" for i in range(12) if rng.random() < 0.4],) for _ in range(400)]
    frame = spark.createDataFrame([r for r in rows if r[0]], "items array<string>")
    key = lambda df: sorted((tuple(r["items"]), r["size"], r.freq, r.n) for r in df.collect())
    whole = rl.frequent_itemsets(frame, 0.02)
    for length in (1, 2, 4):
        assert key(rl.frequent_itemsets(frame, 0.02, max_len=length)) == key(whole.where(f"size <= {length}"))


def test_a_dense_case_with_a_length_limit(spark):
    """Every basket holds all 60 items: 2**60 itemsets are frequent, 1770 pairs are asked for."""
    frame = spark.range(300).select(F.expr("transform(sequence(1, 60), x -> lpad(x, 2, '0'))").alias("items"))
    sets = rl.frequent_itemsets(frame, 0.9, max_len=2).collect()
    assert len(sets) == 60 + 1770 and {r.freq for r in sets} == {300}


def test_fp_growth_gets_like_baskets_together(spark, monkeypatch):
    """Equal baskets dealt over eight partitions come to FP-growth in few."""
    from pyspark.sql import functions as F

    rows = [([f"i{k}", f"j{k}"],) for k in range(20) for _ in range(8)]
    frame = spark.createDataFrame(rows, "items array<string>").repartition(8)
    seen = []

    class Watched(rl.FPGrowth):
        def fit(self, dataset):
            seen.append(dataset.select(F.spark_partition_id(), "items").distinct().count())
            return super().fit(dataset)

    monkeypatch.setattr(rl, "FPGrowth", Watched)
    assert rl.frequent_itemsets(frame, 0.05).count() == 60
    assert seen == [20]


def test_stripping_is_the_patterns(spark):
    from pyspark.sql import functions as F

    from tillroll.functions.text import strip_ws

    ends = ["", " ", "\t", "\n", "\r\n", "\u0085", " \u0085", "\u2028", "\u00a0", "\x0b", "!", "~", "\u00e9"]
    texts = [(a + m + b,) for a in ends for m in ("", "x", "x y") for b in ends] + [(None,)]
    c = F.col("t")
    same = strip_ws(c).eqNullSafe(F.regexp_replace(c, r"^\s+|\s+$", ""))
    assert spark.createDataFrame(texts, "t string").where(~same).count() == 0
