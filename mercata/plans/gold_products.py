"""Aggregates of the enriched listings, by subcategory, tier, brand and store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.functions import columns as C
from mercata.functions.exact import (
    count_mean, half_up, mean, money_mean, pct, pct_sum, rated, rating_mean, rounded,
    safe_ratio, sum_if, total_money,
)
from mercata.operators.ranks import majority, null_safe_join, quantiles, with_quantiles
from mercata.operators.relational import pivot_labels, top_k


def is_active():
    return F.col("bought_last_month") > 0


def has_badge():
    return F.col("is_best_seller")


def outcomes() -> list:
    """Measures most tables share."""
    return [
        F.count(F.lit(1)).alias("product_count"),
        money_mean("price_cents").alias("avg_price"),
        rating_mean("rating_tenths").alias("avg_rating"),
        count_mean("review_count").alias("avg_reviews"),
        F.sum("bought_last_month").alias("total_units_sold"),
        total_money("revenue_cents").alias("total_revenue"),
        money_mean("revenue_cents").alias("avg_revenue_per_product"),
        pct(is_active()).alias("pct_active"),
        pct(has_badge()).alias("pct_best_sellers"),
    ]


def discount_mean(name: str):
    return mean("discount_tenths", 1, 10).alias(name)


MEDIAN_PRICE = {"median_price": ("price_cents", 0.5, 1, 100)}


def subcategory_landscape(products: DataFrame) -> DataFrame:
    agg = products.groupBy("subcategory").agg(
        *outcomes(),
        pct(F.col("review_count") == 0).alias("pct_zero_reviews"),
        discount_mean("avg_discount_pct"),
        pct_sum("has_brand").alias("pct_with_brand"),
        pct_sum("has_features").alias("pct_with_features"),
        pct_sum("has_description").alias("pct_with_description"),
        pct_sum("has_store").alias("pct_with_store"),
    )
    return with_quantiles(agg, products, ["subcategory"], MEDIAN_PRICE)


def join_ecosystem(profile: DataFrame, revenue: DataFrame) -> DataFrame:
    """Category profiles with listing revenue where there is any."""
    return profile.join(revenue, "main_category", "left")


def main_category_landscape(profile: DataFrame, products: DataFrame) -> DataFrame:
    revenue = (
        products.where(F.col("main_category").isNotNull())
        .groupBy("main_category")
        .agg(
            F.count(F.lit(1)).alias("listed_products"),
            F.sum("bought_last_month").alias("total_units_sold"),
            F.sum("revenue_cents").alias("_revenue"),
            money_mean("revenue_cents").alias("avg_revenue_per_product"),
            money_mean("price_cents").alias("avg_price"),
            rating_mean("rating_tenths").alias("avg_rating"),
            pct(is_active()).alias("pct_active"),
        )
    )
    catalogue = profile.select(
        "main_category", F.col("product_count").alias("ecosystem_products"),
        "store_count", "brand_count",
        "pct_with_features", "pct_with_description", "pct_with_brand", "pct_with_store",
    )
    return join_ecosystem(catalogue, revenue).withColumns({
        "listing_coverage_pct": rounded("listed_products", "ecosystem_products", 10000, 100),
        "total_revenue": F.col("_revenue") / 100.0,
        "products_per_store": rounded("ecosystem_products", "store_count", 10, 10),
        "revenue_per_store": rounded("_revenue", "store_count", 1, 100),
    }).drop("_revenue")


def price_positioning(products: DataFrame) -> DataFrame:
    keys = ["subcategory", "price_tier"]
    agg = products.groupBy(*keys).agg(
        *outcomes(),
        discount_mean("avg_discount_pct"),
        pct_sum("has_brand").alias("pct_branded"),
        count_mean("title_length").alias("avg_title_length"),
        pct_sum("has_features").alias("pct_with_features"),
    )
    return with_quantiles(agg, products, keys, MEDIAN_PRICE)


def brand_dynamics(products: DataFrame) -> DataFrame:
    status = products.withColumn("brand_status", C.brand_status("has_brand"))
    return status.groupBy("subcategory", "brand_status").agg(
        *outcomes(), discount_mean("avg_discount_pct")
    )


def discount_effectiveness(products: DataFrame) -> DataFrame:
    """Listings with a list price, by discount depth; those not discounted form their own tier."""
    priced = products.where(F.col("list_cents") > 0).withColumn(
        "discount_tier", C.discount_tier("discount_tenths")
    )
    return priced.groupBy("subcategory", "discount_tier").agg(*outcomes(), discount_mean("avg_discount"))


def listing_quality(products: DataFrame) -> DataFrame:
    parts = ["features", "description", "brand"]
    filled = sum(F.col(f"has_{p}") for p in [*parts, "store"])
    split = []
    for p in parts:
        split += [
            money_mean("revenue_cents", F.col(f"has_{p}") == 1).alias(f"avg_rev_with_{p}"),
            money_mean("revenue_cents", F.col(f"has_{p}") == 0).alias(f"avg_rev_without_{p}"),
        ]
    agg = products.groupBy("subcategory").agg(
        F.count(F.lit(1)).alias("product_count"),
        count_mean("title_length").alias("avg_title_length"),
        *[pct_sum(f"has_{p}").alias(f"pct_with_{p}") for p in [*parts, "store"]],
        *split,
        *[
            money_mean("revenue_cents", band(F.col("title_length"))).alias(f"avg_rev_{name}")
            for name, band in C.TITLE_BANDS.items()
        ],
        mean(filled, 100, 100).alias("avg_completeness_score"),
        money_mean("revenue_cents", filled >= 3).alias("avg_rev_high_completeness"),
        money_mean("revenue_cents", filled <= 1).alias("avg_rev_low_completeness"),
    )
    return with_quantiles(
        agg, products, ["subcategory"], {"median_title_length": ("title_length", 0.5, 10, 1)}
    )


def bestseller_analysis(products: DataFrame) -> DataFrame:
    def both(name, measure):
        return [
            measure(has_badge()).alias(f"{name}_bestseller"),
            measure(~has_badge()).alias(f"{name}_non_bestseller"),
        ]

    with_badge = F.avg(F.when(has_badge(), F.col("revenue_cents")))
    without = F.avg(F.when(~has_badge(), F.col("revenue_cents")))
    return products.groupBy("subcategory").agg(
        F.count(F.lit(1)).alias("total_products"),
        F.sum(has_badge().cast("long")).alias("bestseller_count"),
        rounded(F.sum(has_badge().cast("long")), F.count(F.lit(1)), 10000, 100).alias("pct_bestsellers"),
        *both("avg_price", lambda w: money_mean("price_cents", w)),
        *both("avg_rating", lambda w: rating_mean("rating_tenths", w)),
        *both("avg_reviews", lambda w: count_mean("review_count", w)),
        *both("avg_rev", lambda w: money_mean("revenue_cents", w)),
        *both("avg_sales", lambda w: count_mean("bought_last_month", w)),
        rounded(
            F.coalesce(sum_if(has_badge(), "revenue_cents"), F.lit(0)), F.sum("revenue_cents"), 1000, 10
        ).alias("pct_revenue_from_bestsellers"),
        half_up(F.try_divide(with_badge, without), 10).alias("bestseller_revenue_multiplier"),
    )


def _quartiles(prefix_to_spec: dict) -> dict:
    return {
        f"{prefix}_p{round(q * 100)}": (c, q, scale, per_unit)
        for prefix, (c, scale, per_unit) in prefix_to_spec.items()
        for q in (0.25, 0.5, 0.75)
    }


BENCHMARKS = _quartiles({
    "price": ("price_cents", 1, 100),
    "reviews": ("review_count", 1, 1),
    "rating": ("rating_tenths", 10, 10),
    "sales": ("bought_last_month", 1, 1),
    "revenue": ("revenue_cents", 1, 100),
})


def product_benchmarks(products: DataFrame) -> DataFrame:
    priced = products.where(F.col("price_cents").isNotNull())
    agg = priced.groupBy("subcategory").agg(F.count(F.lit(1)).alias("product_count"))
    return with_quantiles(agg, priced, ["subcategory"], BENCHMARKS)


def join_review_summary(products: DataFrame, summary: DataFrame) -> DataFrame:
    """Listings with their review summaries; a product reviewed under two
    source categories appears once for each."""
    reviewed = summary.withColumnRenamed("avg_rating", "review_rating").drop("review_count")
    return products.join(reviewed, F.col("asin") == F.col("parent_asin"), "left")


def category_benchmarks_full(products: DataFrame, summary: DataFrame) -> DataFrame:
    joined = join_review_summary(products, summary)
    agg = joined.groupBy("subcategory").agg(
        F.count(F.lit(1)).alias("product_count"),
        count_mean("title_length").alias("avg_title_length"),
        pct_sum("has_features").alias("pct_with_features"),
        pct_sum("has_description").alias("pct_with_description"),
        pct_sum("has_brand").alias("pct_with_brand"),
        discount_mean("avg_discount_pct"),
        rated("review_rating", 100).alias("avg_review_rating"),
        rated("pct_verified", 10).alias("avg_pct_verified"),
        rated("pct_negative", 10).alias("avg_pct_negative"),
        rated("reviews_per_month", 100).alias("avg_reviews_per_month"),
        rated("avg_text_length", 10).alias("avg_review_text_length"),
        F.count("parent_asin").alias("products_with_reviews"),
    )
    return with_quantiles(agg, joined, ["subcategory"], BENCHMARKS)


def store_performance(stores: DataFrame, products: DataFrame) -> DataFrame:
    """Catalogue profile and listing results of every store that has listings.

    Listings are summed per store before the join, so each side meets with one row per store.
    """
    sold = products.where(F.col("store").isNotNull()).groupBy("store").agg(
        F.count("asin").alias("listed_products"),
        money_mean("price_cents").alias("avg_price"),
        total_money("revenue_cents").alias("total_revenue"),
        money_mean("revenue_cents").alias("avg_revenue_per_product"),
        F.sum("bought_last_month").alias("total_units_sold"),
        rounded(F.count_if(is_active()), F.count("asin"), 1000, 10).alias("pct_active"),
        rating_mean("rating_tenths").alias("avg_rating"),
        count_mean("review_count").alias("avg_reviews"),
    )
    profile = stores.select(
        "store", "store_type", F.col("product_count").alias("ecosystem_products"),
        "category_count", "brand_count",
        F.col("avg_rating").alias("ecosystem_avg_rating"),
        F.col("avg_reviews").alias("ecosystem_avg_reviews"),
    )
    return join_store(profile, sold)


def join_store(profile: DataFrame, sold: DataFrame) -> DataFrame:
    return profile.join(sold.where(F.col("listed_products") > 0), "store")


# ---- reports over the tables above ----------------------------------------

def brand_multiplier_top(brand_dynamics: DataFrame, k: int = 10) -> DataFrame:
    wide = pivot_labels(
        brand_dynamics, "subcategory", "brand_status",
        {"Branded": "branded_rev", "Unbranded": "unbranded_rev"}, "avg_revenue_per_product",
    ).where("branded_rev is not null and unbranded_rev > 0")
    ratio = wide.withColumn("brand_multiplier", safe_ratio("branded_rev", "unbranded_rev", 10))
    return top_k(ratio, "brand_multiplier", k, tiebreak=["subcategory"])


def completeness_top(listing_quality: DataFrame, k: int = 5) -> DataFrame:
    ratio = listing_quality.where(
        "avg_rev_high_completeness is not null and avg_rev_low_completeness > 0"
    ).select(
        "subcategory", "avg_completeness_score", "avg_rev_high_completeness",
        "avg_rev_low_completeness",
        safe_ratio("avg_rev_high_completeness", "avg_rev_low_completeness", 10).alias(
            "completeness_multiplier"
        ),
    )
    return top_k(ratio, "completeness_multiplier", k, tiebreak=["subcategory"])


def badge_top(bestsellers: DataFrame, k: int = 5, min_badges: int = 10) -> DataFrame:
    kept = bestsellers.where(F.col("bestseller_count") >= min_badges).select(
        "subcategory", "bestseller_count", "pct_bestsellers", "avg_rev_bestseller",
        "avg_rev_non_bestseller", "bestseller_revenue_multiplier",
    )
    return top_k(kept, "bestseller_revenue_multiplier", k, tiebreak=["subcategory"])


def store_type_performance(store_performance: DataFrame) -> DataFrame:
    return store_performance.groupBy("store_type").agg(
        F.count(F.lit(1)).alias("stores"),
        rated("avg_revenue_per_product", 100).alias("avg_rev_per_product"),
        rated("pct_active", 10).alias("avg_pct_active"),
    )


def match_rate(benchmarks_full: DataFrame) -> DataFrame:
    return benchmarks_full.select(
        "subcategory", "product_count", "products_with_reviews",
        rounded("products_with_reviews", "product_count", 1000, 10).alias("pct_matched"),
    )


def enrichment_coverage(products: DataFrame) -> DataFrame:
    return products.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum("is_matched").alias("enriched"),
        rounded(F.sum("is_matched"), F.count(F.lit(1)), 1000, 10).alias("pct_enriched"),
        F.count_if(F.col("list_cents") > 0).alias("has_list_price"),
        F.sum(has_badge().cast("long")).alias("bestsellers"),
        F.sum("has_features").alias("has_features"),
        F.sum("has_description").alias("has_description"),
        F.count("title").alias("has_title"),
    )


def leaderboard(df: DataFrame, c: str, k: int, asc: bool = False, key: list[str] | None = None) -> DataFrame:
    return top_k(df, c, k, asc, key)


def lookup(df: DataFrame, filters: dict, sort: list | None = None, k: int | None = None) -> DataFrame:
    """Rows matching every equality, ordered and cut as asked."""
    for name, value in filters.items():
        df = df.where(F.col(name) == F.lit(value))
    if sort:
        df = df.orderBy(*sort)
    return df if k is None else df.limit(k)


def taxonomy_agreement(products: DataFrame, k: int = 20) -> DataFrame:
    """Subcategories whose listings agree least on a main category."""
    known = products.where(F.col("main_category").isNotNull())
    return top_k(majority(known, ["subcategory"], "main_category"), "pct", k, asc=True, tiebreak=["subcategory"])
