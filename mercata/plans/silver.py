"""Enriched listings, the full catalogue, category and store profiles, reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mercata.functions import columns as C
from mercata.functions.exact import count_mean, pct_sum, rating_mean, money_mean, units
from mercata.operators.ranks import with_quantiles


def attach_category(listings: DataFrame, categories: DataFrame) -> DataFrame:
    """Listings with their subcategory name; unknown ids keep a null name.

    Category tables hold a few hundred rows; Spark broadcasts them by their measured size.
    """
    names = categories.select(F.col("id").alias("category_id"), F.col("category_name").alias("subcategory"))
    return listings.join(names, "category_id", "left")


def with_category(listings: DataFrame, categories: DataFrame) -> DataFrame:
    """Listings whose category is known."""
    names = categories.select(F.col("id").alias("category_id"), "category_name")
    return listings.join(names, "category_id")


def one_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Keep the first row per key, for sources that repeat ids."""
    w = W.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def products(
    listings: DataFrame, categories: DataFrame, metadata: DataFrame,
    dedupe: bool = False, dedupe_metadata: bool = True,
) -> DataFrame:
    """One row per listing, enriched; money in cents, stars in tenths.

    Listing ids may repeat and are kept by default.  Of repeated metadata ids the most-rated row
    is joined, so that none multiplies a listing; ``dedupe_metadata=False`` trusts them to be unique.
    """
    if dedupe:
        listings = one_per_key(listings, "asin", "review_count", "title")
    if dedupe_metadata:
        metadata = one_per_key(metadata, "parent_asin", "rating_number", "title")
    known = metadata.select(
        F.col("parent_asin").alias("_parent"),
        "main_category", "store",
        F.col("details_brand").alias("brand"),
        F.col("details_manufacturer").alias("manufacturer"),
        "features", "description",
        F.col("categories").alias("metadata_categories"),
    )
    joined = attach_category(listings, categories).join(
        known, F.col("asin") == F.col("_parent"), "left"
    )
    return C.listing_parts(joined).select(
        "asin", "subcategory", "main_category", "title", "price_cents", "list_cents",
        C.discount_tenths("price_cents", "list_cents").alias("discount_tenths"),
        "rating_tenths", "review_count", "is_best_seller", "bought_last_month",
        C.estimated_revenue("price_cents", "bought_last_month").alias("revenue_cents"),
        C.price_tier("price_cents").alias("price_tier"),
        "store", "brand", "manufacturer", "features", "description", "metadata_categories",
        F.length("title").cast("long").alias("title_length"),
        "has_features", "has_description", "has_store", "has_brand",
        F.col("_parent").isNotNull().cast("int").alias("is_matched"),
        "flag_no_price", "flag_no_reviews", "flag_no_sales", "flag_no_rating", "flag_no_title",
    )


def present_products(df: DataFrame) -> DataFrame:
    """Enriched listings in reader's units."""
    return df.withColumns({
        "price": units("price_cents"),
        "list_price": units("list_cents"),
        "discount_pct": units("discount_tenths", 10),
        "rating": units("rating_tenths", 10),
        "estimated_revenue": units("revenue_cents"),
    }).drop("price_cents", "list_cents", "discount_tenths", "rating_tenths", "revenue_cents")


def products_full(metadata: DataFrame) -> DataFrame:
    """The whole catalogue in standard columns, without products lacking a main category."""
    named = metadata.where(F.col("main_category").isNotNull()).withColumnsRenamed({
        "details_brand": "brand", "details_manufacturer": "manufacturer",
        "rating_number": "review_count",
    })
    return C.listing_parts(named).select(
        "parent_asin", "main_category", "title", "rating_tenths", "review_count",
        C.parse_price("price").alias("price_cents"),
        "store", "brand", "manufacturer", "features", "description", "categories",
        F.length("title").cast("long").alias("title_length"),
        "has_store", "has_brand", "has_features", "has_description",
        "flag_no_price", "flag_no_store", "flag_no_brand", "flag_no_title", "flag_no_ratings",
    )


def present_products_full(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "price": units("price_cents"), "rating": units("rating_tenths", 10),
    }).drop("price_cents", "rating_tenths")


def category_profile(full: DataFrame) -> DataFrame:
    """Catalogue size, breadth, means and coverage per main category."""
    agg = full.groupBy("main_category").agg(
        F.count(F.lit(1)).alias("product_count"),
        F.count_distinct("store").alias("store_count"),
        F.count_distinct("brand").alias("brand_count"),
        rating_mean("rating_tenths").alias("avg_rating"),
        count_mean("review_count").alias("avg_reviews"),
        money_mean("price_cents").alias("avg_price"),
        pct_sum("has_features").alias("pct_with_features"),
        pct_sum("has_description").alias("pct_with_description"),
        pct_sum("has_brand").alias("pct_with_brand"),
        pct_sum("has_store").alias("pct_with_store"),
    )
    return with_quantiles(agg, full, ["main_category"], {"median_price": ("price_cents", 0.5, 1, 100)})


def stores(full: DataFrame, focused_up_to: int = 3) -> DataFrame:
    """Catalogue size, breadth and means per store."""
    n_categories = F.count_distinct("main_category")
    return (
        full.where(F.col("store").isNotNull())
        .groupBy("store")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            n_categories.alias("category_count"),
            F.count_distinct("brand").alias("brand_count"),
            rating_mean("rating_tenths").alias("avg_rating"),
            count_mean("review_count").alias("avg_reviews"),
            F.sum("has_features").alias("products_with_features"),
            F.sum("has_description").alias("products_with_description"),
        )
        .withColumn("store_type", C.store_type("category_count", focused_up_to))
    )


def dated(flagged: DataFrame) -> DataFrame:
    """Reviews with their calendar date, all other columns as they are."""
    when = C.utc_date("timestamp")
    return flagged.withColumns({
        "review_date": when, "review_year": F.year(when).cast("long"), "review_month": F.month(when).cast("long"),
    })


def reviews(flagged: DataFrame) -> DataFrame:
    """Reviews with their calendar date; a view, nothing is copied."""
    return dated(flagged).select(
        "rating", "title", "text", "asin", "parent_asin", "user_id", "timestamp",
        "review_date", "review_year", "review_month",
        "helpful_vote", "verified_purchase", "image_count", "source_category",
        "text_length", "has_text", "has_title", "has_helpful_votes",
    )


def review_facts(flagged: DataFrame) -> DataFrame:
    """Of the reviews only what summaries and trust of products read."""
    return dated(flagged).select(
        "parent_asin", "source_category", "user_id", "rating", "review_date", "helpful_vote", "verified_purchase", "image_count",
        "text_length", "has_text",
    )
