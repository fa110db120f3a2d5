"""The questions a dashboard asks, as functions of a market."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.functions import columns as C
from mercata.functions.exact import half_up, minor, rounded, safe_ratio, weighted_mean
from mercata.market import Market
from mercata.operators import ranks as R
from mercata.operators.relational import label_rank, pivot_labels, sort_by_label, top_k, unpivot
from mercata.plans import analysis
from mercata.plans.gold_products import lookup
from mercata.plans.gold_reviews import unverified_gap

ROUND4 = 10**4


# ---- category scout ---------------------------------------------------------------

def scout_summary(m: Market) -> DataFrame:
    return m.subcategory_landscape.agg(
        (F.sum(minor("total_revenue")) / 100.0).alias("total_revenue"),
        F.sum("product_count").alias("products"),
        F.count(F.lit(1)).alias("subcategories"),
        half_up(F.sum(minor("avg_rating")) / F.count("avg_rating") / 100, ROUND4).alias("avg_rating"),
    )


def scout_ecosystem(m: Market, k: int = 33) -> DataFrame:
    top = m.main_category_landscape.orderBy(
        F.desc_nulls_last("total_revenue"), "main_category"
    ).limit(k)
    return top.agg(
        F.sum("ecosystem_products").alias("ecosystem_products"),
        F.sum("store_count").alias("stores"),
        F.sum("brand_count").alias("brands"),
        F.count(F.lit(1)).alias("main_categories"),
    )


def category_trend(m: Market, category: str, since: int = 2015) -> DataFrame:
    """Monthly volume and rating of one category, with the month as a date."""
    return (
        m.temporal_trends.where((F.col("source_category") == category) & (F.col("review_year") >= since))
        .select(
            "review_year", "review_month",
            C.month_start(F.col("review_year").cast("int"), F.col("review_month").cast("int")).alias("date"),
            "review_count", "avg_rating", "pct_verified", "pct_negative",
        )
        .orderBy("review_year", "review_month")
    )


# ---- positioning ------------------------------------------------------------------

def positioning_tiers(m: Market, subcategory: str) -> DataFrame:
    return sort_by_label(
        lookup(m.price_positioning, {"subcategory": subcategory}), "price_tier", C.PRICE_TIER_ORDER
    )


def positioning_discounts(m: Market, subcategory: str) -> DataFrame:
    return sort_by_label(
        lookup(m.discount_effectiveness, {"subcategory": subcategory}),
        "discount_tier", C.DISCOUNT_TIER_ORDER,
    )


def positioning(m: Market, subcategory: str) -> DataFrame:
    """One row: totals, weighted rating, winning tier and brand multiplier of a subcategory.

    The winning tier has the highest revenue per product; ties go to the cheaper tier.
    """
    tiers = lookup(m.price_positioning, {"subcategory": subcategory})
    winner = F.max_by(
        "price_tier", F.struct("avg_revenue_per_product", -label_rank("price_tier", C.PRICE_TIER_ORDER))
    )
    summary = tiers.groupBy("subcategory").agg(
        F.sum("product_count").alias("products"),
        (F.sum(minor("total_revenue")) / 100.0).alias("total_revenue"),
        half_up(
            F.sum(minor("avg_rating") * F.col("product_count"))
            / F.greatest(F.sum("product_count"), F.lit(1)) / 100, ROUND4,
        ).alias("weighted_rating"),
        winner.alias("winning_tier"),
    )
    brands = pivot_labels(
        lookup(m.brand_dynamics, {"subcategory": subcategory}), "subcategory", "brand_status",
        {"Branded": "branded_rev", "Unbranded": "unbranded_rev"}, "avg_revenue_per_product",
    ).select("subcategory", safe_ratio("branded_rev", "unbranded_rev", 10).alias("brand_multiplier"))
    return summary.join(brands, "subcategory", "left")


def archetype_mix_of(m: Market, subcategory: str) -> DataFrame:
    """Products and mean ranks of each archetype in a subcategory."""
    return (
        lookup(m.product_clusters, {"subcategory": subcategory})
        .groupBy("cluster_name")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            *[F.avg(f"{r}_rank").alias(f"avg_{r}_rank") for r in ("price", "sales", "reviews")],
        )
        .orderBy(F.desc("product_count"), "cluster_name")
    )


def archetype_ranks_long(m: Market, subcategory: str) -> DataFrame:
    wide = archetype_mix_of(m, subcategory)
    return unpivot(
        wide, ["cluster_name"], ["avg_price_rank", "avg_sales_rank", "avg_reviews_rank"], "metric", "avg_rank"
    )


def listing_impact(m: Market, subcategory: str) -> DataFrame:
    return analysis.listing_lift(lookup(m.listing_quality, {"subcategory": subcategory}))


# ---- health check ------------------------------------------------------------------

HEALTH_COLUMNS = {
    "price_pctile": "price_cents", "rating_pctile": "rating_tenths", "reviews_pctile": "review_count",
    "sales_pctile": "bought_last_month", "revenue_pctile": "revenue_cents",
}


def health_position(m: Market, asins: list[str]) -> DataFrame:
    """Where products stand in their subcategory on five measures, 0 to 1."""
    return R.percentile_position(m.products, "subcategory", "asin", asins, HEALTH_COLUMNS)


def health_archetype(m: Market, asin: str) -> DataFrame:
    """A product's archetype beside how common each archetype is in its subcategory."""
    clusters = m.product_clusters
    mine = clusters.where(F.col("asin") == asin).select(
        "asin", "subcategory", F.col("cluster_name").alias("own_archetype")
    )
    mix = clusters.groupBy("subcategory", "cluster_name").agg(F.count(F.lit(1)).alias("products"))
    return R.null_safe_join(mine, mix, ["subcategory"], "inner").orderBy(F.desc("products"), "cluster_name")


def probability_band(p) -> "F.Column":
    return F.when(p >= 0.6, "strong").when(p >= 0.4, "middling").otherwise("weak")


def health_diagnosis(m: Market, model, asins: list[str], parts: int = 3, leaves=None) -> DataFrame:
    """Success probability of products, its band, and what helps and hurts most.

    ``leaves`` of the model (see :func:`mercata.ml.attributions.tree_leaves`) are read once by the caller."""
    from mercata.ml import success
    from mercata.ml.attributions import explain

    ranks = R.percentile_position(
        m.products, "subcategory", "asin", asins,
        {"price_rank": "price_cents", "reviews_rank": "review_count", "title_length_rank": "title_length"},
    )
    rows = m.products.where(F.col("asin").isin(asins))
    features = success.feature_columns(R.null_safe_join(rows, ranks, ["asin", "subcategory"], "inner"))
    explained = explain(model, features, leaves)
    entries = F.array(*[
        F.struct(F.col(f"shap_{f}").alias("value"), F.lit(f).alias("feature"))
        for f in success.FEATURES
    ])
    helping = F.slice(F.sort_array(F.filter(entries, lambda e: e["value"] > 0), False), 1, parts)
    hurting = F.slice(F.sort_array(F.filter(entries, lambda e: e["value"] < 0), True), 1, parts)
    return explained.select(
        "asin", "subcategory", "probability", probability_band(F.col("probability")).alias("band"),
        "base_value", "margin",
        F.transform(helping, lambda e: e["feature"]).alias("helping"),
        F.transform(hurting, lambda e: e["feature"]).alias("hurting"),
    )


# ---- voice of the customer ------------------------------------------------------------

def voice_sentiment(m: Market, category: str) -> DataFrame:
    return lookup(m.review_sentiment, {"source_category": category})


def voice_words(m: Market, category: str, sentiment: str, k: int = 20) -> DataFrame:
    words = lookup(m.review_keywords, {"source_category": category, "sentiment": sentiment})
    return top_k(words.select("word", "word_count"), "word_count", k, tiebreak=["word"])


def voice_trend(m: Market, category: str, since: int = 2015) -> DataFrame:
    trend = lookup(m.temporal_trends, {"source_category": category})
    return trend.where(F.col("review_year") >= since).select(
        "review_year", "review_month", "review_count", "avg_rating", "pct_negative",
        "negative_reviews", "positive_reviews", "neutral_reviews",
    ).orderBy("review_year", "review_month")


# ---- trust ------------------------------------------------------------------------------

def trust_overview(m: Market) -> DataFrame:
    """Review total and verified and extreme rates weighted by volume."""
    return m.review_trust.agg(
        F.sum("total_reviews").alias("total_reviews"),
        half_up(weighted_mean(minor("pct_verified", 10), "total_reviews") / 10, ROUND4).alias("avg_verified"),
        half_up(weighted_mean(minor("pct_extreme_ratings", 10), "total_reviews") / 10, ROUND4).alias("avg_extreme"),
        F.count(F.lit(1)).alias("categories"),
    )


def trust_gap_ranking(m: Market) -> DataFrame:
    return unverified_gap(m.review_trust, None)


def _in_category(m: Market, category: str | None) -> DataFrame:
    scores = m.product_trust_scores
    return scores if category is None else lookup(scores, {"source_category": category})


def trust_summary(m: Market, category: str | None = None) -> DataFrame:
    flagged = F.col("is_suspicious")
    return _in_category(m, category).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(flagged).alias("suspicious_count"),
        rounded(F.count_if(flagged), F.greatest(F.count(F.lit(1)), F.lit(1)), 1000, 10).alias("pct_suspicious"),
        F.avg("trust_score").alias("avg_trust"),
        F.avg(F.when(flagged, F.col("trust_score"))).alias("avg_trust_suspicious"),
        F.avg(F.when(~flagged, F.col("trust_score"))).alias("avg_trust_normal"),
    )


PROFILE = {
    "avg_reviews": ("review_count", 1), "avg_velocity": ("reviews_per_day", 1),
    "avg_verified_pct": ("verified_rate", 100), "avg_5star": ("pct_5star", 1),
    "avg_short_text_pct": ("short_text_rate", 100),
    "avg_reviews_per_reviewer": ("reviews_per_reviewer", 1),
    "avg_unverified_gap": ("unverified_5star_gap", 1),
}


def compare_groups(scores: DataFrame) -> DataFrame:
    """Mean profile of flagged and normal products."""
    label = F.when(F.col("is_suspicious"), "Suspicious").otherwise("Normal")
    return scores.groupBy(label.alias("group_label")).agg(
        F.count(F.lit(1)).alias("products"),
        *[(F.avg(c) * by).alias(name) for name, (c, by) in PROFILE.items()],
    )


def trust_profiles(m: Market, category: str | None = None) -> DataFrame:
    return compare_groups(_in_category(m, category))


def trust_products(m: Market, category: str | None = None, k: int = 50) -> DataFrame:
    """The least trusted flagged products, optionally of one category."""
    return analysis.top_suspicious(_in_category(m, category), k)
