"""Derived columns and row-level flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.functions.exact import col, rounded

# Tier names and bounds (cents, tenths of a percent, stars).
PRICE_TIERS = [(1000, "Budget"), (2500, "Low"), (5000, "Mid"), (10000, "Premium")]
TOP_PRICE_TIER = "Luxury"
NO_PRICE = "Unknown"
PRICE_TIER_ORDER = ["Budget", "Low", "Mid", "Premium", "Luxury"]
EDA_PRICE_TIERS = [
    (1000, "1. Under $10"), (2500, "2. $10-25"), (5000, "3. $25-50"), (10000, "4. $50-100"),
]
EDA_TOP_PRICE_TIER = "5. $100+"
NO_DISCOUNT = "No Discount"
DISCOUNT_TIERS = [(200, "Light (1-19%)"), (500, "Medium (20-49%)")]
TOP_DISCOUNT_TIER = "Deep (50%+)"
DISCOUNT_TIER_ORDER = ["No Discount", "Light (1-19%)", "Medium (20-49%)", "Deep (50%+)"]
SALES_TIERS = [(1, "1. Zero sales"), (50, "2. 1-49"), (500, "3. 50-499"), (5000, "4. 500-4999")]
TOP_SALES_TIER = "5. 5000+"
SIZE_TIERS = [
    (1, "1 product"), (5, "2-5 products"), (20, "6-20 products"), (100, "21-100 products"),
]
TOP_SIZE_TIER = "100+ products"
RATING_BINS = [
    (200, "0-2"), (300, "2-3"), (350, "3-3.5"), (400, "3.5-4"), (450, "4-4.5"), (501, "4.5-5"),
]
TRUST_TIERS = [
    (20, "Very Low (0-20)"), (40, "Low (20-40)"), (60, "Medium (40-60)"),
    (80, "High (60-80)"), (100, "Very High (80-100)"),
]
EM_DASH = "—"
MILLIS_PER_DAY = 86_400_000


def _below(value: Column, steps, otherwise) -> Column:
    """First label whose bound lies above the value."""
    chain = F.when(value < steps[0][0], steps[0][1])
    for bound, label in steps[1:]:
        chain = chain.when(value < bound, label)
    return chain.otherwise(otherwise)


def _up_to(value: Column, steps, otherwise=None) -> Column:
    """First label whose bound is at or above the value (right-closed bins)."""
    chain = F.when(value <= steps[0][0], steps[0][1])
    for bound, label in steps[1:]:
        chain = chain.when(value <= bound, label)
    return chain if otherwise is None else chain.otherwise(otherwise)


# ---- labels ---------------------------------------------------------------

def price_tier(cents, bounds=PRICE_TIERS, top=TOP_PRICE_TIER, unknown=NO_PRICE) -> Column:
    cents = col(cents)
    return F.when(cents.isNull(), unknown).otherwise(_below(cents, bounds, top))


def discount_tier(tenths, bounds=DISCOUNT_TIERS, top=TOP_DISCOUNT_TIER, none=NO_DISCOUNT) -> Column:
    tenths = col(tenths)
    return F.when(tenths.isNull() | (tenths <= 0), none).otherwise(_below(tenths, bounds, top))


def sales_tier(sold, bounds=SALES_TIERS, top=TOP_SALES_TIER) -> Column:
    return _below(col(sold), bounds, top)


def size_tier(n) -> Column:
    """Store size by listed products; right-closed, nothing below one product."""
    n = col(n)
    return F.when(n > 0, _up_to(n, SIZE_TIERS, TOP_SIZE_TIER))


def rating_bin(hundredths) -> Column:
    """Right-closed store-rating bins over (0, 5.01], in hundredths of a star."""
    r = col(hundredths)
    return F.when(r > 0, _up_to(r, RATING_BINS))


def trust_tier(score) -> Column:
    """Five 20-point bins, 0 included in the lowest."""
    score = col(score)
    return F.when(score >= 0, _up_to(score, TRUST_TIERS))


def store_type(n_categories, focused_up_to: int = 3) -> Column:
    n = col(n_categories)
    return (
        F.when(n == 1, "Specialist").when(n <= focused_up_to, "Focused").otherwise("Generalist")
    )


def brand_status(has_brand) -> Column:
    return F.when(col(has_brand) == 1, "Branded").otherwise("Unbranded")


def is_positive(rating="rating") -> Column:
    return col(rating) >= 4


def is_neutral(rating="rating") -> Column:
    return col(rating) == 3


def is_negative(rating="rating") -> Column:
    return col(rating) <= 2


SENTIMENTS = ("negative", "neutral", "positive")  # labels of :func:`sentiment`


def sentiment(rating="rating") -> Column:
    """Label for a review; whatever is neither positive nor negative is neutral,
    including half stars and a missing rating."""
    return (
        F.when(is_positive(rating), "positive")
        .when(is_negative(rating), "negative")
        .otherwise("neutral")
    )


# ---- numbers --------------------------------------------------------------

def parse_price(c) -> Column:
    """Price text to integer cents; text that is no number gives null."""
    number = F.regexp_replace(col(c), "[$,]", "").try_cast("decimal(18,2)")
    return F.when(col(c) != EM_DASH, (number * 100).cast("long"))


def discount_tenths(price, list_price) -> Column:
    """Discount in tenths of a percent, only where a real discount exists."""
    price, full = col(price), col(list_price)
    return F.when(
        (price > 0) & (full > price),
        F.floor((1000 * (full - price)).cast("double") / full + 0.5),
    )


def estimated_revenue(cents, sold) -> Column:
    return col(cents) * col(sold)


def utc_date(millis) -> Column:
    """Calendar day of an epoch in milliseconds, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(col(millis) / MILLIS_PER_DAY).cast("int"))


def month_start(year, month) -> Column:
    return F.make_date(col(year), col(month), F.lit(1))


def months_between_dates(first, last) -> Column:
    """Number of month boundaries crossed."""
    first, last = col(first), col(last)
    return (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)


# ---- presence -------------------------------------------------------------

def is_filled(c) -> Column:
    """Neither null, blank nor an empty stringified list."""
    trimmed = F.trim(col(c))
    return F.coalesce((trimmed != "") & (trimmed != "[]"), F.lit(False))


def flag(cond) -> Column:
    """A condition as true/false, with unknown counted as false."""
    return F.coalesce(cond, F.lit(False))


def as_int(cond) -> Column:
    return flag(cond).cast("int")


def _missing_text(c) -> Column:
    return col(c).isNull() | (col(c) == "")


def flag_metadata(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "flag_no_price": _missing_text("price") | flag(F.col("price") == EM_DASH),
        "flag_no_store": _missing_text("store"),
        "flag_no_brand": _missing_text("details_brand"),
        "flag_no_title": _missing_text("title"),
        "flag_no_ratings": flag(F.col("rating_number") == 0),
    })


def flag_categories(df: DataFrame) -> DataFrame:
    name = F.trim("category_name")
    return df.withColumns({
        "flag_missing_name": (F.col("category_name").isNull() | flag(name == "")).cast("int"),
        "name_length": F.length(name).cast("long"),
    })


def flag_reviews(df: DataFrame) -> DataFrame:
    """Presence flags and text length, computed where the text is scanned so the
    text itself need not travel further."""
    return df.withColumns({
        "has_text": flag(F.col("text") != ""),
        "has_title": flag(F.col("title") != ""),
        "has_helpful_votes": F.col("helpful_vote") > 0,
        "text_length": F.length("text").cast("long"),
    })


def flag_listings(df: DataFrame) -> DataFrame:
    def absent(c):
        return F.col(c).isNull() | (F.col(c) == 0)

    return df.withColumns({
        "flag_no_price": absent("price_cents"),
        "flag_no_reviews": absent("review_count"),
        "flag_no_sales": absent("bought_last_month"),
        "flag_no_rating": absent("rating_tenths"),
        "flag_no_title": F.col("title").isNull() | (F.trim("title") == ""),
    })


def listing_parts(df: DataFrame) -> DataFrame:
    """0/1 flags for the parts of a listing that are filled in."""
    return df.withColumns({
        "has_features": is_filled("features").cast("int"),
        "has_description": is_filled("description").cast("int"),
        "has_store": F.col("store").isNotNull().cast("int"),
        "has_brand": F.col("brand").isNotNull().cast("int"),
    })


# Title-length bands overlap at 100, so each is its own condition.
TITLE_BANDS = {
    "short_title": lambda n: n < 50,
    "medium_title": lambda n: n.between(50, 100),
    "long_title": lambda n: n.between(100, 150),
    "very_long_title": lambda n: n > 150,
}


def normalise_listings(df: DataFrame) -> DataFrame:
    """Raw listing rows with money in cents and stars in tenths."""
    return df.select(
        "asin",
        "title",
        "category_id",
        (F.col("price") * 100).cast("long").alias("price_cents"),
        (F.col("listPrice") * 100).cast("long").alias("list_cents"),
        F.round(F.col("stars") * 10).cast("long").alias("rating_tenths"),
        F.col("reviews").alias("review_count"),
        F.col("boughtInLastMonth").alias("bought_last_month"),
        F.col("isBestSeller").alias("is_best_seller"),
    )


def normalise_metadata(df: DataFrame) -> DataFrame:
    """Raw metadata rows with the average rating in tenths."""
    return df.withColumn("rating_tenths", F.round(F.col("average_rating") * 10).cast("long")).drop(
        "average_rating"
    )
