"""Hand-computed tables on a small market."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from mercata.functions import columns as C
from mercata.market import Market
from mercata.plans import analysis as A
from mercata.plans import gold_products as gp
from mercata.plans import gold_reviews as gr
from mercata.plans import quality, serving, silver

DAY = 86_400_000


def millis(y, m, d):
    return int((dt.date(y, m, d) - dt.date(1970, 1, 1)).days) * DAY


@pytest.fixture(scope="module")
def market(spark):
    listings = spark.createDataFrame(
        [
            ("a", "x" * 100, 1, 1000, 2000, 45, 10, 100, True),
            ("b", "short", 1, 5000, 5000, 40, 0, 0, False),
            ("c", "words", 1, None, 0, 0, 5, 50, False),
            ("d", "y" * 60, 99, 999, None, 50, 7, 10, False),
            ("e", None, 2, 20000, 25000, 30, 1, 1, True),
            ("e", "again", 2, 20000, 25000, 30, 1, 1, False),
        ],
        "asin string, title string, category_id int, price_cents long, list_cents long, rating_tenths long, "
        "review_count long, bought_last_month long, is_best_seller boolean",
    )
    categories = spark.createDataFrame([(1, "Toys"), (2, "Books"), (3, "Empty")], "id int, category_name string")
    metadata = spark.createDataFrame(
        [
            ("a", "Play", "t", 45, 10, "$1,234.50", "S1", "['f']", "[]", "[]", "Brand", "M"),
            ("b", None, "t", 40, 0, "—", "S1", "[]", "d", "[]", None, None),
            ("x", "Play", "t", 30, None, "from 12", "S2", None, " ", "[]", "Brand", None),
            ("y", "Read", "t", 35, 2, "12.00", "S1", "f", "d", "[]", None, None),
        ],
        "parent_asin string, main_category string, title string, rating_tenths long, rating_number long, "
        "price string, store string, features string, description string, categories string, "
        "details_brand string, details_manufacturer string",
    )
    reviews = spark.createDataFrame(
        [
            (5.0, "Great toy", "fine toy that works", "a", "u1", millis(2020, 1, 31), 3, True, 1, "Toys"),
            (1.0, "Bad toy", "ok", "a", "u1", millis(2020, 3, 1), 0, False, 0, "Toys"),
            (5.0, "toy", None, "a", "u2", millis(2022, 5, 1), None, False, None, "Toys"),
            (3.5, "", "x" * 30, "a", "u3", millis(1999, 1, 1), 1, True, 2, "Games"),
            (4.0, "toy", "unknown product", "zzz", "u4", millis(2021, 1, 1), 1, True, 0, "Toys"),
            (2.0, None, "y" * 19, "b", "u5", millis(2026, 1, 1), 0, True, 0, "Toys"),
        ],
        "rating double, title string, text string, parent_asin string, user_id string, timestamp long, "
        "helpful_vote long, verified_purchase boolean, image_count long, source_category string",
    ).withColumn("asin", F.col("parent_asin"))
    return Market(
        listings=C.flag_listings(listings), categories=C.flag_categories(categories),
        metadata=C.flag_metadata(metadata), reviews=C.flag_reviews(reviews), keyword_min_count=1,
    )


def by(df, *key):
    rows = df.collect()
    return {r[key[0]] if len(key) == 1 else tuple(r[k] for k in key): r for r in rows}


def test_listings_keep_duplicates_unless_asked(market):
    rows = market.products.collect()
    assert len(rows) == 6
    deduped = silver.products(market.listings, market.categories, market.metadata, dedupe=True)
    assert deduped.count() == 5
    d = by(market.products.where("asin = 'd'"), "asin")["d"]
    assert d.subcategory is None and d.price_tier == "Budget" and d.discount_tenths is None
    a = by(market.products, "asin")["a"]
    assert (a.revenue_cents, a.discount_tenths, a.is_matched, a.has_features, a.has_description) == (100000, 500, 1, 1, 0)


def test_repeated_metadata_multiplies_only_when_kept(market):
    twice = market.metadata.unionByName(market.metadata)
    assert silver.products(market.listings, market.categories, twice, dedupe_metadata=False).count() == 8
    assert silver.products(market.listings, market.categories, twice).count() == 6


def test_full_catalogue_drops_only_rows_without_category(market):
    full = by(market.products_full, "parent_asin")
    assert set(full) == {"a", "x", "y"} and full["a"].price_cents == 123450 and full["x"].price_cents is None
    profile = by(market.category_profile, "main_category")["Play"]
    assert (profile.product_count, profile.store_count, profile.avg_rating, profile.avg_reviews) == (2, 2, 3.75, 10.0)
    assert (profile.median_price, profile.pct_with_features) == (1234.5, 50.0)
    stores = by(market.stores, "store")
    assert stores["S1"].store_type == "Focused" and stores["S2"].store_type == "Specialist"


def test_landscape_keeps_the_unknown_subcategory(market):
    land = by(market.subcategory_landscape, "subcategory")
    assert set(land) == {"Toys", "Books", None}
    toys = land["Toys"]
    assert (toys.product_count, toys.avg_price, toys.median_price, toys.total_revenue) == (3, 30.0, 30.0, 1000.0)
    assert (toys.avg_revenue_per_product, toys.pct_active, toys.pct_zero_reviews) == (500.0, 66.7, 33.3)
    assert land[None].median_price == 9.99


def test_discounts_leave_out_listings_without_list_price(market):
    tiers = by(market.discount_effectiveness, "subcategory", "discount_tier")
    assert set(tiers) == {("Toys", "Deep (50%+)"), ("Toys", "No Discount"), ("Books", "Medium (20-49%)")}
    assert tiers[("Books", "Medium (20-49%)")].product_count == 2


def test_title_bands_and_multiplier(market):
    q = by(market.listing_quality, "subcategory")["Toys"]
    assert q.avg_rev_medium_title == q.avg_rev_long_title == 1000.0 and q.avg_rev_very_long_title is None
    b = by(market.bestseller_analysis, "subcategory")
    assert b["Toys"].bestseller_revenue_multiplier is None  # no badge-free revenue: zero denominator
    assert b["Books"].bestseller_revenue_multiplier == 1.0 and b["Books"].pct_revenue_from_bestsellers == 50.0


def test_stores_need_listings(market):
    perf = by(market.store_performance, "store")
    assert set(perf) == {"S1"} and perf["S1"].listed_products == 2 and perf["S1"].total_revenue == 1000.0


def test_product_summary_per_category_and_known_products(market):
    s = by(market.product_review_summary, "parent_asin", "source_category")
    assert set(s) == {("a", "Toys"), ("a", "Games"), ("b", "Toys")}
    toys = s[("a", "Toys")]
    assert (toys.review_count, toys.avg_rating, toys.median_rating) == (3, 3.67, 5.0)
    assert (toys.review_span_days, toys.reviews_per_month) == (821, 0.11)
    assert (toys.reviews_since, toys.avg_rating_since, toys.pct_verified) == (1, 5.0, 33.3)
    games = s[("a", "Games")]
    assert (games.positive_count, games.neutral_count, games.negative_count) == (0, 0, 0)


def test_product_trust(market):
    t = by(market.product_review_trust, "parent_asin", "source_category")
    toys = t[("a", "Toys")]
    assert (toys.unique_reviewers, toys.reviews_per_reviewer, toys.pct_extreme_ratings) == (2, 1.5, 100.0)
    assert (toys.pct_5star_unverified, toys.pct_5star_verified, toys.pct_very_short_text) == (50.0, 100.0, 66.7)
    assert t[("b", "Toys")].pct_5star_unverified is None
    assert t[("b", "Toys")].pct_very_short_text == 100.0


def test_benchmarks_count_a_product_once_per_category(market):
    full = by(market.category_benchmarks_full, "subcategory")["Toys"]
    assert (full.product_count, full.products_with_reviews) == (4, 3)


def test_trend_window_and_sentiment(market):
    trend = market.temporal_trends
    assert trend.agg(F.min("review_year"), F.max("review_year")).first()[:] == (2020, 2022)
    s = by(market.review_sentiment, "source_category")
    assert (s["Games"].pct_positive, s["Games"].pct_neutral, s["Games"].pct_negative) == (0.0, 0.0, 0.0)
    assert s["Toys"].negative_verbosity_ratio == half(10.5 / 17.0)


def half(x):
    return int(x * 100 + 0.5) / 100


def test_keywords_and_their_ratio(market):
    words = by(market.review_keywords, "source_category", "sentiment", "word")
    assert words[("Toys", "positive", "toy")].word_count == 3 and ("Toys", "negative", "bad") in words
    ratio = by(gr.distinctive_keywords(market.review_keywords, "positive"), "word")
    assert set(ratio) == {"toy"} and ratio["toy"].ratio == 3.0
    assert market.review_keywords.where("word_count >= 50").count() == 0


def test_health_and_positioning(market):
    p = by(serving.health_position(market, ["a"]), "asin")["a"]
    assert (p.price_pctile, p.sales_pctile, p.reviews_pctile) == (0.0, 1.0, 1.0)
    one = serving.positioning(market, "Toys").first()
    assert (one.products, one.winning_tier, one.brand_multiplier) == (3, "Low", None)
    assert serving.category_trend(market, "Toys", 2020).count() == 4
    assert serving.category_trend(market, "Toys", 2021).count() == 2


def test_typology_and_opportunity(market):
    kinds = by(A.category_typology(market.subcategory_landscape), "subcategory")
    assert kinds["Toys"].category_type in {"Star", "Niche Premium", "Volume Play", "Graveyard"}
    scores = A.opportunity_score(market.subcategory_landscape, n=None).collect()
    assert len(scores) == 3 and all(0 <= r.opportunity_score <= 100.001 for r in scores)


def test_checks(market):
    def passed(df):
        return [r.passed for r in df.collect()]

    assert passed(quality.check_rows(market.products, 6)) == [True]
    assert passed(quality.check_rows(market.products.where("false"))) == [False]
    assert passed(quality.check_not_null(market.products, ["asin", "title"])) == [True, False]
    assert passed(quality.check_range(market.review_sentiment, "avg_rating", 0, 5)) == [True]
    assert passed(quality.check_cardinality(market.products, "asin", 5)) == [True]
    assert passed(quality.check_rate(market.products, "is_best_seller", 2, 10)) == [False]
    assert passed(quality.check_columns(market.products, ["asin", "nope"])) == [True, False]
    assert passed(quality.require_tables({"a": market.products}, ["a", "b"])) == [True, False]


def test_market_reads_what_was_written(spark, market, tmp_path):
    copy = Market(**{n: market._input(n) for n in Market.INPUTS})
    copy.write(str(tmp_path), ["products", "subcategory_landscape"])
    loaded = Market.load(spark, str(tmp_path))
    assert loaded.subcategory_landscape.count() == 3
    assert by(gp.leaderboard(loaded.subcategory_landscape, "total_revenue", 1), "subcategory").keys() == {"Toys"}
