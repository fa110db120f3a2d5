"""Aggregates of the reviews, by product, category, month and word."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.functions import columns as C
from mercata.functions.exact import (
    count_if, floor_ratio, half_up, mean, pct, pct_of, rounded, safe_ratio,
)
from mercata.operators.relational import (
    explode_tokens, only_known, pivot_labels, sample_rows, top_k,
)
from mercata.operators.sketches import QUANTILE_K, sketch_quantile

PRODUCT = ["parent_asin", "source_category"]


def rows():
    return F.count(F.lit(1))


def is_verified():
    return F.col("verified_purchase")


def is_extreme():
    return F.col("rating").isin(1, 5)


def has_stars(n: int):
    return F.col("rating") == n


def has_images():
    return F.col("image_count") > 0


def has_text():
    return F.col("has_text")


def star_mean(where=None):
    """Mean rating, two decimals.  Ratings are whole or half stars, so doubles add exactly."""
    return mean("rating", 100, 100, where)


def text_mean(where=None):
    """Mean length of the texts that are there, one decimal."""
    return mean("text_length", 10, 10, has_text() if where is None else has_text() & where)


def median_stars():
    """Exact median of the ratings, one decimal: few distinct values, so the buffer is small."""
    return half_up(F.median("rating"), 10)


def product_review_summary(
    reviews: DataFrame, products: DataFrame, since: str = "2022-01-01", approx_median: bool = False
) -> DataFrame:
    """Volume, sentiment, span and recent reviews per product and source category.

    One job over all categories.  Reviews are combined per product before the
    semi join with the listings, so a product with very many reviews is one row by then.
    With ``approx_median`` medians come from bounded sketches, interpolated as the exact ones are.
    """
    recent = F.col("review_date") >= F.to_date(F.lit(since))
    first, last = F.min("review_date"), F.max("review_date")
    sketch = F.kll_sketch_agg_double("rating", F.lit(QUANTILE_K))
    median = sketch_quantile(sketch, 0.5) if approx_median else F.median("rating")
    per_product = reviews.groupBy(*PRODUCT).agg(
        rows().alias("review_count"),
        star_mean().alias("avg_rating"),
        median.alias("median_rating"),
        first.alias("first_review_date"),
        last.alias("last_review_date"),
        F.datediff(last, first).cast("long").alias("review_span_days"),
        floor_ratio(rows(), C.months_between_dates(first, last)).alias("reviews_per_month"),
        count_if(C.is_positive()).alias("positive_count"),
        count_if(C.is_neutral()).alias("neutral_count"),
        count_if(C.is_negative()).alias("negative_count"),
        pct(C.is_positive()).alias("pct_positive"),
        pct(C.is_negative()).alias("pct_negative"),
        pct(is_verified()).alias("pct_verified"),
        mean("helpful_vote", 100, 100).alias("avg_helpful_vote"),
        F.sum("helpful_vote").alias("total_helpful_votes"),
        pct(has_images()).alias("pct_with_images"),
        text_mean().alias("avg_text_length"),
        count_if(recent).alias("reviews_since"),
        star_mean(recent).alias("avg_rating_since"),
    )
    return only_known(per_product, products, "parent_asin")


SHARES = 4  # tasks that a product's users are counted in


def reviewers(reviews: DataFrame, keys: list[str], shares: int | None = None) -> DataFrame:
    """Distinct users of each group.

    Where groups are many and small, each user of a group falls to one of ``shares`` shares of it, and rows are dealt by group and
    share: a group has few counts to add up then, instead of one in nearly every task, and its rows lie together in the shuffle.
    """
    if shares is None:
        return reviews.groupBy(*keys).agg(F.count_distinct("user_id").alias("unique_reviewers"))
    dealt = reviews.select(*keys, "user_id", F.pmod(F.xxhash64("user_id"), F.lit(shares)).cast("int").alias("_share"))
    counted = dealt.repartition(*keys, "_share").groupBy(*keys, "_share").agg(F.count_distinct("user_id").alias("_users"))
    return counted.groupBy(*keys).agg(F.sum("_users").alias("unique_reviewers"))


def with_reviewers(plain: DataFrame, reviews: DataFrame, keys: list[str], total: str, shares: int | None = None) -> DataFrame:
    """Add the distinct users of each group to its plain aggregates, after the column ``total`` of its reviews.

    Users are counted apart, in rows of the keys and a user: beside other aggregates every user of a group would carry a copy
    of all their sums.
    """
    users = reviewers(reviews, keys, shares)
    same = [F.col(f"_u.{k}").eqNullSafe(F.col(f"_p.{k}")) for k in keys]
    joined = plain.alias("_p").join(users.alias("_u"), reduce(and_, same))
    after = [c for c in plain.columns if c not in (*keys, total)]
    return joined.select(
        *[F.col(f"_p.{k}") for k in keys], total, "unique_reviewers",
        rounded(total, "unique_reviewers", 100, 100).alias("reviews_per_reviewer"), *after,
    )


def product_review_trust(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Reviewer diversity, extremes, verification split and pace per product and category.

    Reviews and users are combined per product before the semi join with the listings.
    """
    days = F.datediff(F.max("review_date"), F.min("review_date"))
    per_product = reviews.groupBy(*PRODUCT).agg(
        rows().alias("review_count"),
        pct(is_extreme()).alias("pct_extreme_ratings"),
        pct(has_stars(5)).alias("pct_5star"),
        pct(has_stars(1)).alias("pct_1star"),
        pct(is_verified()).alias("pct_verified"),
        pct_of(has_stars(5), ~is_verified()).alias("pct_5star_unverified"),
        pct_of(has_stars(5), is_verified()).alias("pct_5star_verified"),
        pct(has_text()).alias("pct_with_text"),
        text_mean().alias("avg_text_length"),
        pct(has_text() & (F.col("text_length") < 20)).alias("pct_very_short_text"),
        floor_ratio(rows(), days, scale=10000).alias("reviews_per_day"),
        pct(F.col("helpful_vote") > 0).alias("pct_with_helpful_votes"),
    )
    return with_reviewers(only_known(per_product, products, "parent_asin"), reviews, PRODUCT, "review_count", SHARES)


def join_trust(trust: DataFrame, summary: DataFrame, min_reviews: int = 5) -> DataFrame:
    span = summary.select(*PRODUCT, "review_span_days", "reviews_per_month", "pct_negative")
    return trust.where(F.col("review_count") >= min_reviews).join(span, PRODUCT)


def review_trust(reviews: DataFrame) -> DataFrame:
    """Rating distribution and trust signals per source category."""
    per_category = reviews.groupBy("source_category").agg(
        rows().alias("total_reviews"),
        pct(is_verified()).alias("pct_verified"),
        pct(~is_verified()).alias("pct_unverified"),
        pct(has_images()).alias("pct_with_images"),
        pct(has_text()).alias("pct_with_text"),
        mean("helpful_vote", 100, 100).alias("avg_helpful_votes"),
        text_mean().alias("avg_text_length"),
        *[pct(F.col("rating") == s).alias(f"pct_{s}star") for s in (5, 4, 3, 2, 1)],
        pct(is_extreme()).alias("pct_extreme_ratings"),
        pct_of(has_stars(5), ~is_verified()).alias("pct_5star_among_unverified"),
        pct_of(has_stars(5), is_verified()).alias("pct_5star_among_verified"),
    )
    return with_reviewers(per_category, reviews, ["source_category"], "total_reviews")


def review_sentiment(reviews: DataFrame) -> DataFrame:
    """Sentiment split, text length, votes and images per source category."""
    neg_length = F.avg(F.when(C.is_negative() & has_text(), F.col("text_length")))
    pos_length = F.avg(F.when(C.is_positive() & has_text(), F.col("text_length")))
    return reviews.groupBy("source_category").agg(
        rows().alias("total_reviews"),
        star_mean().alias("avg_rating"),
        median_stars().alias("median_rating"),
        count_if(C.is_positive()).alias("positive_count"),
        count_if(C.is_neutral()).alias("neutral_count"),
        count_if(C.is_negative()).alias("negative_count"),
        pct(C.is_positive()).alias("pct_positive"),
        pct(C.is_neutral()).alias("pct_neutral"),
        pct(C.is_negative()).alias("pct_negative"),
        pct(has_text()).alias("pct_with_text"),
        text_mean().alias("avg_text_length"),
        text_mean(C.is_negative()).alias("avg_text_length_negative"),
        text_mean(C.is_positive()).alias("avg_text_length_positive"),
        half_up(F.try_divide(neg_length, pos_length), 100).alias("negative_verbosity_ratio"),
        mean("helpful_vote", 100, 100, C.is_negative()).alias("avg_helpful_negative"),
        mean("helpful_vote", 100, 100, C.is_positive()).alias("avg_helpful_positive"),
        pct_of(has_images(), C.is_negative()).alias("pct_images_negative"),
        pct_of(has_images(), C.is_positive()).alias("pct_images_positive"),
    )


def temporal_trends(reviews: DataFrame, first_year: int = 2000, last_year: int = 2025) -> DataFrame:
    """Monthly volume, ratings and sentiment per source category."""
    kept = reviews.where(F.col("review_year").between(first_year, last_year))
    return kept.groupBy("source_category", "review_year", "review_month").agg(
        rows().alias("review_count"),
        star_mean().alias("avg_rating"),
        median_stars().alias("median_rating"),
        pct(is_verified()).alias("pct_verified"),
        pct(has_images()).alias("pct_with_images"),
        mean("helpful_vote", 100, 100).alias("avg_helpful_votes"),
        text_mean().alias("avg_text_length"),
        count_if(C.is_negative()).alias("negative_reviews"),
        count_if(C.is_neutral()).alias("neutral_reviews"),
        count_if(C.is_positive()).alias("positive_reviews"),
        pct(C.is_negative()).alias("pct_negative"),
    )


# Words too common to tell anything.
STOPWORDS = (
    "a an the and or but in on at to for of with by from is it was are were be been this that "
    "these those i my me we our you your he she they them their its not no do did does have has "
    "had will would can could should so if just very too also than then more most all any some "
    "such only other one two each about up out into over after how what when where which who why "
    "as both few many much own same well"
).split()


def review_keywords(
    reviews: DataFrame, column: str = "title", min_count: int = 50, sample_pct: float = 100.0,
    sample_key: str = "user_id", texts: DataFrame | None = None,
) -> DataFrame:
    """Word counts per category and sentiment.

    Short and common tokens go right after the split; counts are combined before the shuffle.
    ``texts`` (``column``, text) are given where reviews refer to texts in a table of their own: then each text is split
    once, and its counts meet the numbers of the reviews that refer to it.
    """
    def split(df, c):
        return explode_tokens(df.where(F.col(c) != ""), c, min_length=3).where(~F.col("word").isin(STOPWORDS))

    kept = sample_rows(reviews, sample_pct, sample_key).select("source_category", C.sentiment().alias("sentiment"), column)
    if texts is None:
        counts = split(kept, column).groupBy("source_category", "sentiment", "word").agg(rows().alias("word_count"))
        return counts.where(F.col("word_count") >= min_count)
    # A word of a text meets a category once, with a number for each sentiment; texts are dealt by id before they are split, which
    # serves the words' counts and the join.
    sums = lambda of: [of(label).alias(label) for label in C.SENTIMENTS]
    referring = kept.groupBy("source_category", column).agg(*sums(lambda label: F.count_if(F.col("sentiment") == label)))
    words = split(texts.select(column, "text").repartition(column), "text").groupBy(column, "word").agg(rows().alias("_times"))
    counts = words.join(referring, column).groupBy("source_category", "word").agg(*sums(lambda label: F.sum(F.col(label) * F.col("_times"))))
    each = counts.unpivot(["source_category", "word"], list(C.SENTIMENTS), "sentiment", "word_count")
    return each.where((F.col("word_count") > 0) & (F.col("word_count") >= min_count)).select("source_category", "sentiment", "word", "word_count")


# ---- reports --------------------------------------------------------------

def distinctive_keywords(keywords: DataFrame, side: str = "negative", k: int | None = None) -> DataFrame:
    """Words by how much more often one side uses them than the other.

    Counts are summed over categories.  Words the other side never uses (or
    too rarely to be counted) have no ratio and are left out.
    """
    other = "positive" if side == "negative" else "negative"
    per_word = keywords.groupBy("word", "sentiment").agg(F.sum("word_count").alias("n"))
    wide = pivot_labels(per_word, "word", "sentiment", {side: "own_count", other: "other_count"}, "n")
    ratio = wide.withColumn("ratio", safe_ratio("own_count", "other_count", 100)).where(
        "ratio is not null"
    )
    return ratio if k is None else top_k(ratio, "ratio", k, tiebreak=["word"])


def unverified_gap(trust: DataFrame, k: int | None = 5) -> DataFrame:
    """Categories where unverified reviewers give most five stars beyond verified ones."""
    gap = trust.select(
        "source_category", "pct_verified", "pct_5star_among_unverified", "pct_5star_among_verified",
        half_up(F.col("pct_5star_among_unverified") - F.col("pct_5star_among_verified"), 10).alias(
            "unverified_5star_gap"
        ),
    )
    if k is None:
        return gap.orderBy(F.desc_nulls_last("unverified_5star_gap"), "source_category")
    return top_k(gap, "unverified_5star_gap", k, tiebreak=["source_category"])


def most_suspicious(trust: DataFrame, k: int = 5, min_reviews: int = 50) -> DataFrame:
    """Products with the most extreme ratings, least verified first among equals."""
    return (
        trust.where(F.col("review_count") >= min_reviews)
        .select(
            "parent_asin", "source_category", "review_count", "pct_extreme_ratings", "pct_verified",
            "pct_very_short_text", "reviews_per_day",
        )
        .orderBy(
            F.desc_nulls_last("pct_extreme_ratings"), F.asc_nulls_last("pct_verified"),
            "parent_asin", "source_category",
        )
        .limit(k)
    )


def yearly_volume(trends: DataFrame, since: int = 2019) -> DataFrame:
    from mercata.functions.exact import rated

    return trends.where(F.col("review_year") >= since).groupBy("review_year").agg(
        F.sum("review_count").alias("total_reviews"), rated("avg_rating", 100).alias("avg_rating")
    )


def most_negative(sentiment: DataFrame, k: int = 5) -> DataFrame:
    cols = [
        "source_category", "pct_negative", "avg_text_length_negative",
        "negative_verbosity_ratio", "avg_helpful_negative",
    ]
    return top_k(sentiment.select(*cols), "pct_negative", k, tiebreak=["source_category"])
