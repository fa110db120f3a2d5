"""Marketplace tables played by a generic order database.

The acceptance data has no listings or reviews, so parts, order lines, orders
and documents stand in for them: every part is a listing, every order line a
review of its part, every document a review text.  All rows are used.  Where a
branch needs an odd value (a missing price, an unknown product) the value is
derived, never the row dropped.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.functions import columns as C
from mercata.market import Market
from mercata.operators.relational import add_single_row

RECENT_SINCE = "2000-01-01"
SALES_SINCE = "2001-08-01"
TREND_YEARS = (1995, 2025)   # years the monthly trend table keeps
WINDOW = (1997, 2001)        # years the growth reports compare
RECENT_YEAR, BASE_YEARS = 2000, (1997, 1999)
LISTED_SIZE_UP_TO = 14  # parts this small have a metadata record under their own id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def categories(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.groupBy("p_brand").agg(
        F.first(F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")).alias("id")
    ).select("id", F.col("p_brand").alias("category_name"))


def listings(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part")
    line = table(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity").cast("long")
    per_part = line.groupBy("l_partkey").agg(
        F.sum(F.when(F.col("l_shipdate") >= SALES_SINCE, quantity).otherwise(0)).alias("sold"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.floor(F.avg(10 + 10 * (quantity % 5))).alias("stars10"),
    )
    k = F.col("p_partkey")
    cents = F.floor((F.round(F.col("p_retailprice") * 10).cast("long") * F.col("p_size")) / 40)
    return (
        part.join(per_part, F.col("l_partkey") == k, "left")
        .withColumn("pc", cents)
        .select(
            k.cast("string").alias("asin"),
            F.expr("repeat(concat(p_name, ' '), cast(1 + p_partkey % 16 as int))").alias("title"),
            F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int").alias("category_id"),
            F.when(k % 50 == 7, None).otherwise(F.col("pc")).alias("price_cents"),
            F.when(k % 9 == 4, 0)
            .otherwise(F.floor(F.col("pc") * (100 + 15 * (k % 10)) / 100))
            .alias("list_cents"),
            F.when(k % 23 == 5, 0).otherwise(F.col("stars10")).alias("rating_tenths"),
            F.when(k % 4 == 1, 0)
            .otherwise(F.coalesce("returned", F.lit(0)))
            .alias("review_count"),
            F.coalesce("sold", F.lit(0)).alias("bought_last_month"),
            (k % 37 == 0).alias("is_best_seller"),
        )
    )


def metadata(spark, sf_dir) -> DataFrame:
    """One record per part under a foreign id, plus one under the part's own id
    for small parts, so that about a third of the listings find a match."""
    part = table(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    ids = F.array_append(
        F.when(size <= LISTED_SIZE_UP_TO, F.array(k.cast("string"))).otherwise(
            F.array().cast("array<string>")
        ),
        F.concat(F.lit("X"), k.cast("string")),
    )
    store = (
        F.when(k % 11 == 2, None)
        .when(k % 3 == 0, F.concat(F.lit("Store#"), (k % 20).cast("string")))
        .when(k % 3 == 1, F.concat(F.lit("Store#M"), F.floor(k / 12).cast("string")))
        .otherwise(F.concat(F.lit("Store#S"), k.cast("string")))
    )
    price = (
        F.when(k % 3 == 0, C.EM_DASH)
        .when(k % 13 == 0, "from 12")
        .when(k % 17 == 0, "$1,234.50")
        .otherwise(F.concat(F.lit("$"), size.cast("string"), F.lit(".25")))
    )
    return part.select(F.explode(ids).alias("parent_asin"), "*").select(
        "parent_asin",
        F.when(k % 15 == 3, None).otherwise(F.col("p_type")).alias("main_category"),
        F.col("p_name").alias("title"),
        (10 + (k * 7) % 41).alias("rating_tenths"),
        F.when(k % 19 == 0, None)
        .when(k % 6 == 0, 0)
        .otherwise(size.cast("long") * (k % 13))
        .alias("rating_number"),
        price.alias("price"),
        store.alias("store"),
        F.when(k % 4 == 0, "[]").when(k % 4 == 1, "  ").otherwise(F.col("p_name")).alias("features"),
        F.when(k % 6 == 0, None).otherwise(F.col("p_type")).alias("description"),
        F.concat(F.lit("['"), F.col("p_type"), F.lit("']")).alias("categories"),
        F.when(k % 5 < 3, None).otherwise(F.col("p_brand")).alias("details_brand"),
        F.when(k % 7 == 0, None).otherwise(F.concat(F.lit("Maker of "), "p_brand")).alias(
            "details_manufacturer"
        ),
    )


def review_texts(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select(
        "doc_id", "text",
        (F.col("text") != "").alias("has_text"),
        F.length("text").cast("long").alias("text_length"),
    )


def _ordered_texts(spark, sf_dir) -> DataFrame:
    """Orders with their user and the id of the document that all reviews of an order have for a text."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    docs = table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("_docs"))
    slots = F.col("_docs") + F.floor(F.col("_docs") / 10)
    return add_single_row(orders, docs).select("o_orderkey", "o_custkey", F.try_mod("o_orderkey", slots).alias("text_id"))


def _lines_of(spark, sf_dir, orders: DataFrame, *of_part: str) -> DataFrame:
    """Order lines with columns of their orders and parts.  A line's values are made before it is shuffled, since they take
    less room than what they come from."""
    # Orders first, while rows are narrow; then spread by part, before names and texts are attached.  A large part table needs the
    # same partitioning, and with a product's lines together aggregates per product combine before their shuffle.
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", (F.col("l_returnflag") != "N").alias("verified_purchase"),
        (1 + F.col("l_quantity").cast("long") % 5).cast("byte").alias("stars"), F.to_date("l_shipdate").alias("shipped"),
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", *of_part)
    return (
        line.join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .repartition("l_partkey")  # no number given: as many parts as their size asks for
        .join(part, F.col("p_partkey") == F.col("l_partkey"))
    )


def _review_columns() -> dict[str, Column]:
    """A review's columns, but for its title and text, from :func:`_lines_of`."""
    key = F.col("l_partkey").cast("string")
    second_category = (F.col("l_linenumber") == 1) & ~F.col("verified_purchase")
    return {
        "rating": F.col("stars").cast("double"),
        "asin": key,
        "parent_asin": F.when(F.col("l_linenumber") == 7, F.concat(F.lit("U"), key)).otherwise(key),
        "user_id": F.col("o_custkey").cast("string"),
        "timestamp": F.unix_date("shipped").cast("long") * C.MILLIS_PER_DAY,
        "helpful_vote": (F.col("l_linenumber") - 1).cast("long"),
        "verified_purchase": F.col("verified_purchase"),
        "image_count": (F.col("l_linenumber") % 3).cast("long"),
        "source_category": F.when(second_category, "MISC").otherwise(F.col("p_type")),
        "has_title": F.lit(True),
        "has_helpful_votes": F.col("l_linenumber") > 1,
    }


def review_references(spark, sf_dir) -> DataFrame:
    """Flagged reviews: every order line, with the id of its document (``text_id``) for a text.

    One review in eleven has no text.  A seventh line reviews an unlisted
    product, and a first line in state 'N' files under a second category.
    """
    joined = _lines_of(spark, sf_dir, _ordered_texts(spark, sf_dir), "p_name")
    return joined.select(F.col("p_name").alias("title"), "text_id", *[c.alias(name) for name, c in _review_columns().items()])


def review_facts(spark, sf_dir) -> DataFrame:
    """:func:`reviews` without titles and texts: the same rows, with the length of a text looked up by order, not by review."""
    texts = review_texts(spark, sf_dir).select("doc_id", "text_length")
    orders = _ordered_texts(spark, sf_dir).join(texts, F.col("doc_id") == F.col("text_id"), "left")
    joined = _lines_of(spark, sf_dir, orders.select("o_orderkey", "o_custkey", "text_length"))
    has_text = F.coalesce(F.col("text_length") > 0, F.lit(False))
    return joined.select(*[c.alias(name) for name, c in _review_columns().items()], has_text.alias("has_text"), "text_length")


def reviews(spark, sf_dir) -> DataFrame:
    """Flagged reviews, each with its whole document as text."""
    texts = review_texts(spark, sf_dir)
    joined = review_references(spark, sf_dir).join(texts, F.col("doc_id") == F.col("text_id"), "left")
    return joined.select(
        "rating", "title", "text", "asin", "parent_asin", "user_id", "timestamp", "helpful_vote", "verified_purchase",
        "image_count", "source_category", F.coalesce("has_text", F.lit(False)).alias("has_text"),
        "has_title", "has_helpful_votes", "text_length",
    )


def market(spark: SparkSession, sf_dir: str) -> Market:
    return Market(
        listings=lambda: C.flag_listings(listings(spark, sf_dir)),
        categories=lambda: C.flag_categories(categories(spark, sf_dir)),
        metadata=lambda: C.flag_metadata(metadata(spark, sf_dir)),
        reviews=lambda: reviews(spark, sf_dir),
        review_facts=lambda: review_facts(spark, sf_dir),
        recent_since=RECENT_SINCE,
        trend_years=TREND_YEARS,
    )
