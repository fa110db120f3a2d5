"""Summaries of the reviews that are refreshed load by load.

Each load leaves partial aggregates: exact counts and sums per key and rating, from which every measure of a
summary follows, medians included, since ratings have few values.  Partials of several loads add up, so a late load
costs its own reviews, not all reviews; a load that runs again replaces its own partials.
"""

from __future__ import annotations

import os
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.functions import columns as C
from mercata.functions.exact import floor_ratio, half_up, rounded, sum_if
from mercata.operators.relational import only_known
from mercata.plans import gold_reviews as G
from mercata.plans import silver
from mercata.session import folder_exists

MONTH = ["source_category", "review_year", "review_month"]
SINCE = "2022-01-01"
MEASURES = (
    "n long, verified long, with_images long, votes long, voted long, text_length long, texts long, recent long, "
    "first_review date, last_review date"
)
PARTS = {
    "monthly": f"review_year long, review_month long, rating double, {MEASURES}, source_category string, load string",
    "products": f"parent_asin string, rating double, {MEASURES}, source_category string, load string",
}
KEYS = {"monthly": MONTH, "products": G.PRODUCT}


def partials(reviews: DataFrame, keys: list[str], since: str = SINCE) -> DataFrame:
    """Counts and sums per key and rating of one load's reviews."""
    text = G.has_text() & F.col("text_length").isNotNull()
    count = lambda cond: F.count_if(cond).alias
    return reviews.groupBy(*keys, "rating").agg(
        G.rows().alias("n"), count(G.is_verified())("verified"), count(G.has_images())("with_images"),
        F.coalesce(F.sum("helpful_vote"), F.lit(0)).cast("long").alias("votes"), F.count("helpful_vote").alias("voted"),
        F.coalesce(sum_if(text, "text_length"), F.lit(0)).cast("long").alias("text_length"), count(text)("texts"),
        count(F.col("review_date") >= F.to_date(F.lit(since)))("recent"),
        F.min("review_date").alias("first_review"), F.max("review_date").alias("last_review"),
    )


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key and rating over all loads; merging is associative, so merged partials are partials again."""
    sums = ["n", "verified", "with_images", "votes", "voted", "text_length", "texts", "recent"]
    return parts.groupBy(*keys, "rating").agg(
        *[F.sum(c).alias(c) for c in sums], F.min("first_review").alias("first_review"), F.max("last_review").alias("last_review")
    )


def _count(cond: Column) -> Column:
    return F.coalesce(sum_if(cond, "n"), F.lit(0)).cast("long")


def _share(part: Column) -> Column:
    return rounded(part, F.sum("n"), 1000, 10)


def _stars(count: str) -> Column:
    """Mean rating over the rows that ``count`` counts; whole and half stars add exactly."""
    known = F.when(F.col("rating").isNotNull(), F.col(count))
    return rounded(F.sum(F.col("rating") * F.col(count)), F.sum(known), 100, 100)


def _votes() -> Column:
    return rounded(F.sum("votes"), F.sum("voted"), 100, 100)


def _text_mean() -> Column:
    return rounded(F.sum("text_length"), F.sum("texts"), 10, 10)


def _median() -> Column:
    return F.percentile("rating", F.lit(0.5), F.col("n"))


def trends_of(parts: DataFrame, first_year: int = 2000, last_year: int = 2025) -> DataFrame:
    """What :func:`gold_reviews.temporal_trends` gives over all loads' reviews, from their partials."""
    return parts.where(F.col("review_year").between(first_year, last_year)).groupBy(*MONTH).agg(
        F.sum("n").alias("review_count"), _stars("n").alias("avg_rating"), half_up(_median(), 10).alias("median_rating"),
        _share(F.sum("verified")).alias("pct_verified"), _share(F.sum("with_images")).alias("pct_with_images"),
        _votes().alias("avg_helpful_votes"), _text_mean().alias("avg_text_length"),
        _count(C.is_negative()).alias("negative_reviews"), _count(C.is_neutral()).alias("neutral_reviews"),
        _count(C.is_positive()).alias("positive_reviews"), _share(_count(C.is_negative())).alias("pct_negative"),
    )


def summary_of(parts: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """What :func:`gold_reviews.product_review_summary` gives over all loads' reviews, from their partials.

    Without ``products`` reviews of unlisted products count too.  A product has a few partials a load, so the semi join takes them
    as they are and its shuffle by product serves the sums."""
    first, last = F.min("first_review"), F.max("last_review")
    kept = parts if products is None else only_known(parts, products, "parent_asin")
    return kept.groupBy(*G.PRODUCT).agg(
        F.sum("n").alias("review_count"), _stars("n").alias("avg_rating"), _median().alias("median_rating"),
        first.alias("first_review_date"), last.alias("last_review_date"),
        F.datediff(last, first).cast("long").alias("review_span_days"),
        floor_ratio(F.sum("n"), C.months_between_dates(first, last)).alias("reviews_per_month"),
        _count(C.is_positive()).alias("positive_count"), _count(C.is_neutral()).alias("neutral_count"),
        _count(C.is_negative()).alias("negative_count"),
        _share(_count(C.is_positive())).alias("pct_positive"), _share(_count(C.is_negative())).alias("pct_negative"),
        _share(F.sum("verified")).alias("pct_verified"), _votes().alias("avg_helpful_vote"),
        F.when(F.sum("voted") > 0, F.sum("votes")).alias("total_helpful_votes"),
        _share(F.sum("with_images")).alias("pct_with_images"), _text_mean().alias("avg_text_length"),
        F.sum("recent").alias("reviews_since"), _stars("recent").alias("avg_rating_since"),
    )


def _path(folder: str, name: str) -> str:
    return os.path.join(folder, f"{name}_partials")


def parts_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The partials of all loads."""
    return spark.read.schema(PARTS[name]).parquet(_path(folder, name))


def _categories(parts: DataFrame) -> set:
    return {r[0] for r in parts.select("source_category").distinct().collect()}  # one value for each category


def renew(
    spark: SparkSession, folder: str, categories: set | None = None, products: DataFrame | None = None,
    years: tuple[int, int] = (2000, 2025),
) -> None:
    """Write the summaries of some categories (of all, for None) from the partials.  Other categories' files are neither
    read nor written."""
    within = F.lit(True)
    if categories is not None:
        within = reduce(Column.__or__, [F.col("source_category").eqNullSafe(F.lit(c)) for c in categories], F.lit(False))
    made = {
        "temporal_trends": trends_of(parts_of(spark, folder, "monthly").where(within), *years),
        "product_review_summary": summary_of(parts_of(spark, folder, "products").where(within), products),
    }
    for name, df in made.items():
        (
            df.write.mode("overwrite").option("partitionOverwriteMode", "static" if categories is None else "dynamic")
            .option("compression", "zstd").partitionBy("source_category").parquet(os.path.join(folder, name))
        )


def add_load(
    reviews: DataFrame, folder: str, load: str, products: DataFrame | None = None, since: str = SINCE,
    years: tuple[int, int] = (2000, 2025),
) -> None:
    """Write the partials of one load of flagged reviews, then renew the summaries of the categories it touches.

    ``folder`` gets ``monthly_partials``, ``products_partials``, ``temporal_trends`` and ``product_review_summary``.  A load that
    runs again replaces all that it wrote before, also when its reviews have changed; a run that failed half way is mended by the next.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load):
        raise ValueError(f"a load is named by letters, digits, '_', '.' and '-', not {load!r}")
    spark, touched = reviews.sparkSession, set()
    dated = silver.dated(reviews)
    for name, keys in KEYS.items():
        if folder_exists(spark, f"{_path(folder, name)}/load={load}"):
            touched |= _categories(parts_of(spark, folder, name).where(F.col("load") == load))
        partials(dated, keys, since).write.mode("overwrite").option("partitionOverwriteMode", "static").option(
            "compression", "zstd"
        ).partitionBy("source_category").parquet(f"{_path(folder, name)}/load={load}")
        fresh = _categories(parts_of(spark, folder, name).where(F.col("load") == load))
    gone = (touched - fresh) - _categories(parts_of(spark, folder, "products"))
    renew(spark, folder, None if gone else touched | fresh, products, years)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A summary as the loads so far have left it."""
    made = {"temporal_trends": trends_of, "product_review_summary": summary_of}[name]
    shape = made(parts_of(spark, folder, "monthly" if made is trends_of else "products"))
    return spark.read.schema(shape.schema).parquet(os.path.join(folder, name)).select(*shape.columns)
