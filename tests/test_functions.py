import datetime as dt

import pytest
from pyspark.sql import functions as F

from mercata.functions import columns as C
from mercata.functions import exact as E


def values(df, c):
    return [r[c] for r in df.collect()]


@pytest.mark.parametrize("text,cents", [
    ("$1,234.50", 123450), ("12.00", 1200), ("from 12", None), ("", None), (None, None), ("—", None),
    ("$7", 700),
])
def test_parse_price(frame, text, cents):
    assert values(frame([(text,)], "p string").select(C.parse_price("p").alias("c")), "c") == [cents]


def test_price_tier_edges(frame):
    df = frame([(c,) for c in (None, 0, 999, 1000, 2499, 2500, 4999, 5000, 9999, 10000)], "c long")
    assert values(df.select(C.price_tier("c").alias("t")), "t") == [
        "Unknown", "Budget", "Budget", "Low", "Low", "Mid", "Mid", "Premium", "Premium", "Luxury",
    ]


def test_discount_needs_a_real_reduction(frame):
    df = frame(
        [(1000, 2000), (1000, 1000), (1000, 900), (0, 500), (None, 500), (1000, None), (1999, 2000)],
        "p long, l long",
    ).select(C.discount_tenths("p", "l").alias("d"))
    assert values(df, "d") == [500, None, None, None, None, None, 1]
    tiers = df.select(C.discount_tier("d").alias("t"))
    assert values(tiers, "t")[0] == "Deep (50%+)" and values(tiers, "t")[1] == "No Discount"


def test_discount_tier_edges(frame):
    df = frame([(d,) for d in (None, 0, 1, 199, 200, 499, 500)], "d long")
    assert values(df.select(C.discount_tier("d").alias("t")), "t") == [
        "No Discount", "No Discount", "Light (1-19%)", "Light (1-19%)", "Medium (20-49%)",
        "Medium (20-49%)", "Deep (50%+)",
    ]


def test_right_closed_bins(frame):
    df = frame([(n,) for n in (0, 1, 2, 5, 6, 20, 21, 100, 101)], "n long")
    assert values(df.select(C.size_tier("n").alias("t")), "t") == [
        None, "1 product", "2-5 products", "2-5 products", "6-20 products", "6-20 products",
        "21-100 products", "21-100 products", "100+ products",
    ]
    bins = frame([(r,) for r in (0, 1, 200, 201, 350, 451, 501, 502)], "r long")
    assert values(bins.select(C.rating_bin("r").alias("b")), "b") == [
        None, "0-2", "0-2", "2-3", "3-3.5", "4.5-5", "4.5-5", None,
    ]
    trust = frame([(s,) for s in (0.0, 20.0, 20.1, 80.0, 100.0)], "s double")
    assert values(trust.select(C.trust_tier("s").alias("t")), "t") == [
        "Very Low (0-20)", "Very Low (0-20)", "Low (20-40)", "High (60-80)", "Very High (80-100)",
    ]


def test_sentiment_label_and_count_differ_on_half_stars(frame):
    df = frame([(r,) for r in (1.0, 2.0, 3.0, 3.5, 4.0, None)], "rating double")
    assert values(df.select(C.sentiment().alias("s")), "s") == [
        "negative", "negative", "neutral", "neutral", "positive", "neutral",
    ]
    one = df.agg(F.count_if(C.is_neutral()).alias("n"))
    assert values(one, "n") == [1]


def test_title_of_100_characters_is_in_two_bands(frame):
    df = frame([(n,) for n in (49, 50, 100, 150, 151)], "n long")
    counts = df.agg(*[F.count_if(b(F.col("n"))).alias(k) for k, b in C.TITLE_BANDS.items()]).first()
    assert counts.asDict() == {"short_title": 1, "medium_title": 2, "long_title": 2, "very_long_title": 1}


def test_listing_parts_treat_blank_and_empty_list_as_missing(frame):
    df = frame(
        [("[]", " ", None, ""), (" [] ", "text", "s", None), (None, None, "", "b")],
        "features string, description string, store string, brand string",
    )
    rows = C.listing_parts(df).select("has_features", "has_description", "has_store", "has_brand").collect()
    assert [tuple(r) for r in rows] == [(0, 0, 0, 1), (0, 1, 1, 0), (0, 0, 1, 1)]


def test_metadata_flags(frame):
    df = frame(
        [(None, "", "b", "t", 0), ("—", "s", "", None, None), ("", None, None, "", 3), ("9", "s", "b", "t", 1)],
        "price string, store string, details_brand string, title string, rating_number long",
    )
    rows = C.flag_metadata(df).select(
        "flag_no_price", "flag_no_store", "flag_no_brand", "flag_no_title", "flag_no_ratings"
    ).collect()
    assert [tuple(r) for r in rows] == [
        (True, True, False, False, True), (True, False, True, True, False),
        (True, True, True, True, False), (False, False, False, False, False),
    ]


def test_review_flags(frame):
    df = frame(
        [("", None, None), ("héllo", "t", 0), (None, "", 2)], "text string, title string, helpful_vote long"
    )
    rows = C.flag_reviews(df).select("has_text", "has_title", "has_helpful_votes", "text_length").collect()
    assert [tuple(r) for r in rows] == [
        (False, False, None, 0), (True, True, False, 5), (False, False, True, None),
    ]


def test_dates_are_utc_whatever_the_session_zone(spark, frame):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = frame([(0,), (-1,), (1640995200000,)], "t long")
        assert values(df.select(C.utc_date("t").alias("d")), "d") == [
            dt.date(1970, 1, 1), dt.date(1969, 12, 31), dt.date(2022, 1, 1),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_month_difference_counts_boundaries(frame):
    df = frame([(dt.date(2020, 1, 31), dt.date(2020, 3, 1)), (dt.date(2020, 1, 1), dt.date(2020, 1, 31))], "a date, b date")
    assert values(df.select(C.months_between_dates("a", "b").alias("m")), "m") == [2, 0]


def test_rounding_is_half_up_and_safe(frame):
    df = frame([(1, 2, 3), (None, 5, 0)], "a long, b long, c long")
    out = df.select(
        E.rounded("a", "b", 10, 10).alias("half"), E.safe_ratio("a", "c").alias("ratio"),
        E.floor_ratio("b", "c").alias("floored"),
    ).collect()
    assert tuple(out[0]) == (0.5, 1 / 3, 0.67) and tuple(out[1]) == (None, None, 5.0)


def test_means_of_nothing_are_null(frame):
    df = frame([(1, None)], "k int, c long")
    row = df.agg(E.money_mean("c").alias("m"), E.pct_of(F.lit(True), F.lit(False)).alias("p")).first()
    assert tuple(row) == (None, None)


def test_store_types(frame):
    df = frame([(n,) for n in (1, 2, 3, 4)], "n long").select(C.store_type("n").alias("t"))
    assert values(df, "t") == ["Specialist", "Focused", "Focused", "Generalist"]
