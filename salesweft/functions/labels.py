"""Business labels and text templates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Selling season of a category.
CATEGORY_SEASONS = {
    "Summer": ["T恤", "裙子", "运动"],
    "Winter": ["羽绒服/大衣", "大衣"],
    "Autumn/Winter": ["毛衣", "外套/夹克", "夹克"],
}
ALL_YEAR = "All Year"

# Segment labels.
VIP, STEADY, PROMOTION, OCCASIONAL, ORDINARY = (
    "VIP高价值用户",
    "刚需型用户",
    "大促型用户",
    "随机型用户",
    "普通用户",
)

# Priority and rule-value labels, high to low.
PRIORITIES = ("高", "中", "低")
RULE_VALUES = ("高价值", "中等", "一般")


def price_tier(average_price: Column, low: float = 100.0, mid: float = 200.0) -> Column:
    """Low below ``low``, Mid below ``mid``, else High."""
    return F.when(average_price < low, "Low").when(average_price < mid, "Mid").otherwise("High")


def category_season(category: Column, seasons: dict[str, list[str]] = CATEGORY_SEASONS) -> Column:
    """Selling-season label of a category."""
    label = F.lit(ALL_YEAR)
    for name, members in seasons.items():
        label = F.when(category.isin(members), name).otherwise(label)
    return label


def segment_label(frequency: Column, spend: Column) -> Column:
    """Customer segment from mean orders per month and mean spend."""
    # The limits of the segments.
    return (
        F.when((frequency >= 0.8) & (spend > 6000), VIP)
        .when((frequency >= 0.5) & (frequency < 0.8), STEADY)
        .when((frequency >= 0.2) & (frequency < 0.5), PROMOTION)
        .when(frequency < 0.2, OCCASIONAL)
        .otherwise(ORDINARY)
    )


def stocking_priority(value: Column, median: Column, lower_quartile: Column) -> Column:
    """High from the median up, mid from the lower quartile up, else low."""
    high, mid, low = PRIORITIES
    return F.when(value >= median, high).when(value >= lower_quartile, mid).otherwise(low)


def rule_value(lift: Column) -> Column:
    """Value tier of an association rule."""
    # The limits of the tiers.
    high, mid, low = RULE_VALUES
    return F.when(lift > 1.15, high).when(lift > 1.08, mid).otherwise(low)


def strip_feature_prefix(name: Column) -> Column:
    """``Region_X`` -> ``X`` for the four encoded fields."""
    return F.regexp_replace(name, "^(Region|Season|Category|Price_Range)_", "")


def fixed_text(value: Column, digits: int) -> Column:
    """Number as text with a fixed count of decimals, from a rounded value."""
    rounded = F.rint(value * float(10**digits)) / float(10**digits)
    return F.format_string(f"%.{digits}f", rounded)


def segment_text(size: Column, orders: Column, spend: Column, order_value: Column, frequency: Column) -> Column:
    """Description sentence of a segment."""
    # The words of the sentence.
    return F.concat(
        F.lit("该群体包含"), size.cast("string"),
        F.lit("名用户，平均订单数"), fixed_text(orders, 1),
        F.lit("，平均消费金额"), fixed_text(spend, 0),
        F.lit("元，平均客单价"), fixed_text(order_value, 0),
        F.lit("元，购买频次"), fixed_text(frequency, 1), F.lit("次/月"),
    )


def rule_condition(region: Column, season: Column, category: Column) -> Column:
    """Condition text of a regional rule."""
    # The words of the text.
    return F.concat(
        F.lit("Region="), region, F.lit(", Season="), season, F.lit(", Category="), category
    )


def rule_conclusion(volume: Column) -> Column:
    """Conclusion text of a regional rule."""
    # The words of the text.
    return F.concat(F.lit("Expected Sales Volume: "), fixed_text(volume, 0))


def stocking_text(season: Column, region: Column, category: Column, tier: Column, volume: Column) -> Column:
    """Stocking recommendation sentence."""
    # The words of the sentence.
    return F.concat(
        F.lit("建议在"), season, F.lit("季节向"), region, F.lit("地区重点铺货"), category,
        F.lit("("), tier, F.lit("价位)，预计单店销量"), fixed_text(volume, 0), F.lit("件"),
    )


def composite_key(*parts: Column) -> Column:
    """Parts joined by ``_`` with missing parts as ``Unknown``."""
    return F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("Unknown")) for p in parts])
