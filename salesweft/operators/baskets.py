"""Market baskets: frequent itemsets and association rules.

Support counting works on *weighted baskets*: equal contents are merged with a
weight, so a content that makes up a third of all baskets is one row.  Longer
itemsets come from prefix projection: a basket that holds prefix P is
represented by P and the still frequent items after it, again merged with a
weight.  No basket is joined with itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from salesweft.functions import labels
from salesweft.operators import selection
from salesweft.session import written

SEPARATOR = "+"


def baskets_from_sales(df: DataFrame, keys=("order_date", "city"), item: str = "category") -> DataFrame:
    """Item set per key, e.g. the categories sold per day and city.

    Rows are made distinct first (combined per task), so the list of a
    basket never holds more than its distinct items.
    """
    pairs = selection.present_keys(df, [*keys, item]).select(*keys, F.col(item).alias("item")).distinct()
    return pairs.groupBy(*keys).agg(F.sort_array(F.collect_list("item")).alias("items"))


def limit_baskets(baskets: DataFrame, n: int | None, *order: str) -> DataFrame:
    """First ``n`` baskets in key order, however many they are; all of them by default."""
    return baskets if n is None else selection.first_rows(baskets, n, [F.asc(c) for c in order])


def long_baskets(baskets: DataFrame, keys: list[str], items: str = "items") -> DataFrame:
    """One row per basket and distinct item."""
    return baskets.select(*keys, F.explode(F.array_distinct(items)).alias("item"))


def basket_matrix(baskets: DataFrame, keys: list[str], items: list[str]) -> DataFrame:
    """0/1 columns per item, for export; the item list is the caller's."""
    return baskets.select(
        *keys, *[F.array_contains("items", i).cast("int").alias(i) for i in items]
    )


def item_supports(baskets: DataFrame) -> DataFrame:
    """``(item, n)``: baskets holding each item."""
    return (
        baskets.select(F.explode(F.array_distinct("items")).alias("item"))
        .groupBy("item").agg(F.count("*").alias("n"))
    )


def basket_total(baskets: DataFrame) -> Column:
    """Number of non-empty baskets, as a one-value column for other plans."""
    return baskets.where(F.size("items") > 0).agg(F.count("*").alias("n")).scalar()


def _is_frequent(count: Column, total: Column, min_support: float) -> Column:
    return count / total >= F.lit(float(min_support))


def merged_baskets(baskets: DataFrame) -> DataFrame:
    """``(rest, w)``: equal basket contents merged, with their number."""
    return (
        baskets.select(F.sort_array(F.array_distinct("items")).alias("rest"))
        .where(F.size("rest") > 0)
        .groupBy("rest").agg(F.count("*").alias("w"))
    )


def _count_extensions(projected: DataFrame) -> DataFrame:
    """Support counts of prefix + one further item."""
    return (
        projected.select("prefix", F.explode("rest").alias("item"), "w")
        .groupBy("prefix", "item").agg(F.sum("w").alias("n"))
    )


def _project(projected: DataFrame, frequent: DataFrame, first: bool) -> DataFrame:
    """Baskets seen from prefixes that are one item longer.

    ``allowed`` lists the frequent extensions of a prefix; items outside it
    can never be part of a longer frequent set (subset pruning).  At the first
    level there is one empty prefix, so the list is a single value and no join
    is needed.
    """
    if first:
        listed = projected.withColumn("allowed", frequent.agg(F.collect_set("item")).scalar())
    else:
        listed = projected.join(frequent.groupBy("prefix").agg(F.collect_set("item").alias("allowed")), "prefix")
    pruned = listed.select("prefix", F.array_intersect("rest", "allowed").alias("rest"), "w")
    return (
        # The outer form keeps the intersection from being computed again for a filter.
        pruned.select("prefix", F.posexplode_outer("rest").alias("at", "item"), "rest", "w")
        .where(F.col("at") < F.size("rest") - 1)
        .select(
            F.array_append("prefix", F.col("item")).alias("prefix"),
            F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest"),
            "w",
        )
        .groupBy("prefix", "rest").agg(F.sum("w").alias("w"))
    )


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.01, max_length: int = 3) -> DataFrame:
    """``(items, size, n, support)`` of all frequent sets up to ``max_length``.

    Level by level; every level is written to the shared folder, because
    both its counts and the next level need it.  The baskets themselves are
    read once.
    """
    contents = written(merged_baskets(baskets), "basket-contents")
    total = contents.agg(F.sum("w").alias("n")).scalar()
    no_prefix = F.array().cast("array<string>").alias("prefix")
    projected = contents.select(no_prefix, "rest", "w")
    levels = []
    for length in range(1, max_length + 1):
        counted = _count_extensions(projected).where(_is_frequent(F.col("n"), total, min_support))
        frequent = written(counted, f"itemsets-{length}")
        levels.append(
            frequent.select(
                F.array_append("prefix", F.col("item")).alias("items"),
                F.lit(length).alias("size"), "n", (F.col("n") / total).alias("support"),
            )
        )
        if length == max_length or frequent.isEmpty():
            break
        projected = written(_project(projected, frequent, length == 1), f"basket-suffixes-{length}")
    return written(reduce(DataFrame.unionByName, levels), "itemsets")


def fpgrowth_itemsets(baskets: DataFrame, min_support: float, max_length: int | None = None) -> DataFrame:
    """The same sets by MLlib FP-growth, the choice for long itemsets; its passes read the baskets as written."""
    baskets = written(baskets.select("items"), "fpgrowth-baskets")
    prepared = baskets.select(F.array_distinct("items").alias("items")).where(F.size("items") > 0)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(prepared)
    total = basket_total(baskets)
    sets = model.freqItemsets.select(
        F.sort_array("items").alias("items"), F.size("items").alias("size"), F.col("freq").alias("n")
    ).where(_is_frequent(F.col("n"), total, min_support))
    if max_length is not None:
        sets = sets.where(F.col("size") <= max_length)
    return sets.withColumn("support", F.col("n") / total)


def candidate_itemsets(frequent: DataFrame, k: int) -> DataFrame:
    """Size-k candidates whose subsets of size k-1 are all frequent.

    ``frequent`` holds sorted ``items``.  Sets sharing their first k-2 items
    are joined on that prefix; a candidate survives when all k of its
    subsets are found again.
    """
    smaller = frequent.where(F.size("items") == k - 1).select("items")
    split = smaller.select(
        F.slice("items", 1, k - 2).alias("prefix") if k > 2 else F.array().cast("array<string>").alias("prefix"),
        F.element_at("items", -1).alias("last"),
    )
    grouped = split.groupBy("prefix").agg(F.sort_array(F.collect_set("last")).alias("lasts"))
    # One row per prefix: pair each last item with the ones after it.
    pairs = (
        grouped.select("prefix", "lasts", F.posexplode("lasts").alias("at", "first"))
        .select("prefix", "first", F.explode(F.slice("lasts", F.col("at") + 2, F.size("lasts"))).alias("second"))
    )
    joined = pairs.select(F.concat("prefix", F.array("first", "second")).alias("items"))
    if k == 2:
        return joined
    positions = F.sequence(F.lit(0), F.lit(k - 1))
    subsets = joined.select(
        "items",
        F.explode(F.transform(positions, lambda i: F.filter("items", lambda _, at: at != i))).alias("subset"),
    )
    found = subsets.join(smaller.select(F.col("items").alias("subset")), "subset", "left_semi")
    return found.groupBy("items").agg(F.count("*").alias("found")).where(F.col("found") == k).select("items")


def itemset_supports(baskets: DataFrame, itemsets: DataFrame) -> DataFrame:
    """``(items, n)`` of given sorted itemsets, 0 when never seen together.

    Baskets are merged by content, then meet the itemsets that start with
    one of their items; equal keys only, no comparison of all with all.
    """
    merged = merged_baskets(baskets).withColumnRenamed("rest", "basket")
    wanted = itemsets.select("items", F.element_at("items", 1).alias("key"))
    seen = (
        merged.select("basket", "w", F.explode("basket").alias("key"))
        .join(wanted, "key").where(F.size(F.array_except("items", "basket")) == 0)
        .groupBy("items").agg(F.sum("w").alias("n"))
    )
    return itemsets.select("items").join(seen, "items", "left").select("items", F.coalesce("n", F.lit(0)).alias("n"))


def association_rules(itemsets: DataFrame, min_confidence: float = 0.5, max_length: int = 3) -> DataFrame:
    """Rules from every split of every itemset into two non-empty parts.

    Both parts are subsets of a frequent set, so their supports are found in
    ``itemsets`` itself; nothing is counted again.
    """
    masks = F.expr("sequence(1, shiftleft(1, size(items)) - 2)")
    splits = (
        itemsets.where(F.col("size").between(2, max_length))
        .select("items", "support", F.explode(masks).alias("mask"))
        .select(
            "support",
            F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1) = 1)").alias("antecedent"),
            F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1) = 0)").alias("consequent"),
        )
    )
    side = lambda name: itemsets.select(F.col("items").alias(name), F.col("support").alias(f"{name}_support"))
    joined = splits.join(side("antecedent"), "antecedent").join(side("consequent"), "consequent")
    confidence = F.col("support") / F.col("antecedent_support")
    return (
        joined.withColumn("confidence", confidence)
        .where(F.col("confidence") >= min_confidence)
        .withColumn("lift", F.col("confidence") / F.col("consequent_support"))
        .withColumn("leverage", F.col("support") - F.col("antecedent_support") * F.col("consequent_support"))
        .withColumn(
            "conviction",
            F.when(F.col("confidence") < 1, (1 - F.col("consequent_support")) / (1 - F.col("confidence")))
            .otherwise(F.lit(float("inf"))),
        )
        .select("antecedent", "consequent", "support", "confidence", "lift", "leverage", "conviction")
        .withColumn("value_tier", labels.rule_value(F.col("lift")))
    )


def set_text(items: str | Column) -> Column:
    """Sorted items as one text."""
    return F.array_join(F.sort_array(items), SEPARATOR)


def top_itemsets(itemsets: DataFrame, n: int = 50, min_size: int = 1) -> DataFrame:
    """Most frequent sets, optionally only combinations."""
    return selection.top(
        itemsets.where(F.col("size") >= min_size), n, F.desc("n"), F.asc("size"), set_text("items").asc()
    )


def _rule_order() -> list[Column]:
    # Rounded so that equal lifts tie however they were summed.
    return [F.desc(F.round("lift", 9)), set_text("antecedent").asc(), set_text("consequent").asc()]


def top_rules(rules: DataFrame, n: int = 50, min_lift: float | None = None) -> DataFrame:
    """Rules by lift, optionally above a minimum."""
    if min_lift:
        rules = rules.where(F.col("lift") >= min_lift)
    return selection.top(rules, n, *_rule_order())


def rule_network_nodes(rules: DataFrame, n: int = 15) -> DataFrame:
    """Distinct items of the first rules."""
    return top_rules(rules, n).select(F.explode(F.array_union("antecedent", "consequent")).alias("item")).distinct()


def rule_network_edges(rules: DataFrame, n: int = 15) -> DataFrame:
    """First antecedent -> first consequent of the first rules."""
    first = lambda c: F.coalesce(F.get(F.col(c), 0), F.lit(""))
    return top_rules(rules, n).select(
        first("antecedent").alias("source"), first("consequent").alias("target"),
        F.col("lift").alias("value"), F.greatest("lift", F.lit(1.0)).alias("width"),
    )


def headline_counts(baskets: DataFrame, itemsets: DataFrame, rules: DataFrame) -> DataFrame:
    """Baskets, itemsets and rules found, as one row."""
    count = lambda df: df.agg(F.count("*").alias("n")).scalar()
    return baskets.where(F.size("items") > 0).agg(F.count("*").alias("baskets")).select(
        "baskets", count(itemsets).alias("itemsets"), count(rules).alias("rules")
    )
