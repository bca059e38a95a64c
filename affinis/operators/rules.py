"""Frequent itemsets and association rules over ``(basket_id, item)``, distinct rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.operators.pairs import distinct_total
from affinis.session import cut_lineage


def item_frequency(basket_items: DataFrame) -> DataFrame:
    """Baskets per item."""
    return basket_items.groupBy("item").agg(F.count("*").alias("freq"))


def baskets(basket_items: DataFrame) -> DataFrame:
    """``(basket_id, items)``, items sorted. A basket is at most as long as the item dictionary."""
    return basket_items.groupBy("basket_id").agg(F.array_sort(F.collect_set("item")).alias("items"))


def frequent_itemsets(basket_items: DataFrame, min_support: float) -> DataFrame:
    """``(items, freq)`` by parallel FP-growth; items sorted."""
    return _itemsets(baskets(basket_items), min_support)


def _itemsets(sets: DataFrame, min_support: float) -> DataFrame:
    from pyspark.ml.fpm import FPGrowth

    model = FPGrowth(itemsCol="items", minSupport=min_support).fit(sets)
    return model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")


def association_rules(
    patterns: DataFrame, frequencies: DataFrame, n_baskets: Column | int, confidence: str = "consequent"
) -> DataFrame:
    """``(rest, item, support, confidence)`` in percent for each pattern and each of its items.

    Support is the pattern's share of all baskets. The confidence of ``rest => item`` divides
    by the frequency of the item (``consequent``) or of the rest (``antecedent``). Items
    without a known frequency give no rule.
    """
    total = F.lit(n_baskets) if isinstance(n_baskets, int) else n_baskets
    split = (
        patterns.filter(F.size("items") > 1)
        .select("items", F.col("freq").alias("n"), F.explode("items").alias("item"))
        .withColumn("rest", F.array_except("items", F.array("item")))
    )
    known = split.join(frequencies.select("item", F.col("freq").alias("n_item")), "item")
    if confidence == "consequent":
        rules = known.withColumn("_base", F.col("n_item"))
    elif confidence == "antecedent":
        sizes = patterns.select(F.col("items").alias("rest"), F.col("freq").alias("_base"))
        rules = known.join(sizes, "rest")
    else:
        raise ValueError("confidence is 'consequent' or 'antecedent'")
    return rules.select(
        "rest", "item", (100.0 * F.col("n") / total).alias("support"),
        (100.0 * F.col("n") / F.col("_base")).alias("confidence"),
    )


def rules_for(
    basket_items: DataFrame, min_support: float, confidence: str = "consequent"
) -> DataFrame:
    """Rules straight from baskets.

    Baskets and itemsets are tables: what is counted in both is read from them, and no itemset is found twice.
    """
    sets = cut_lineage(baskets(basket_items))
    return association_rules(
        cut_lineage(_itemsets(sets, min_support)), item_frequency(sets.select(F.explode("items").alias("item"))),
        distinct_total(sets, "basket_id"), confidence,
    )


def rule_lines(rules: DataFrame) -> DataFrame:
    """``(support, confidence, rule)`` as text with 3 decimals and ``rest => item``."""
    return rules.select(
        F.format_string("%5.3f", "support").alias("support"),
        F.format_string("%5.3f", "confidence").alias("confidence"),
        F.concat(F.array_join("rest", "; "), F.lit(" => "), "item").alias("rule"),
    )


def write_rules(rules: DataFrame, path: str) -> None:
    rule_lines(rules).write.mode("overwrite").csv(path)
