"""Reports over listings and the aggregate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.functions import columns as C
from mercata.functions.exact import (
    count_mean, half_up, mean, minor, money_mean, pct, rated, rating_mean, rounded, safe_ratio,
    total_money, weighted_mean,
)
from mercata.operators import ranks as R
from mercata.operators.relational import (
    concat, corr_matrix, corr_pair, extremes, label_rank, pivot_labels, rows_of_top_groups,
    share_of_total, sort_by_label, top_k, trim_upper, value_counts, with_scalars,
)
from mercata.plans.silver import with_category

ROUND4 = 10**4


def revenue_cents():
    """Revenue of an aggregate table as exact cents."""
    return minor("total_revenue")


# ---- listings -----------------------------------------------------------------

def profile_nulls(df: DataFrame, null_cols: list[str], zero_cols: list[str] = ()) -> DataFrame:
    """Rows, and nulls (or blank text) and zeros per column, in one pass."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}

    def is_null(c):
        return F.col(c).isNull() | ((F.col(c) == "") if c in text else F.lit(False))

    return df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(is_null(c)).alias(f"null_{c}") for c in null_cols],
        *[F.count_if(F.col(c) == 0).alias(f"zero_{c}") for c in zero_cols],
    )


def profile_numeric(listings: DataFrame) -> DataFrame:
    """Range and centre of prices and stars, largest counts, badge total."""
    agg = listings.agg(
        (F.min("price_cents") / 100.0).alias("min_price"),
        money_mean("price_cents").alias("avg_price"),
        (F.max("price_cents") / 100.0).alias("max_price"),
        (F.min("rating_tenths") / 10.0).alias("min_stars"),
        mean("rating_tenths", 1, 10).alias("avg_stars"),
        (F.max("rating_tenths") / 10.0).alias("max_stars"),
        F.max("review_count").alias("max_reviews"),
        F.max("bought_last_month").alias("max_bought"),
        F.count_if(F.col("is_best_seller")).alias("bestseller_count"),
    )
    return R.with_quantiles(agg, listings, [], {"median_price": ("price_cents", 0.5, 1, 100)})


def category_demand(listings: DataFrame, categories: DataFrame, k: int = 20, asc: bool = False) -> DataFrame:
    """Categories by units sold, most first (or least)."""
    per = with_category(listings, categories).groupBy("category_name").agg(
        F.count(F.lit(1)).alias("products"),
        money_mean("price_cents").alias("avg_price"),
        rating_mean("rating_tenths").alias("avg_stars"),
        F.count_if(F.col("review_count") > 0).alias("has_reviews"),
        pct(F.col("review_count") > 0).alias("pct_with_reviews"),
        F.sum("bought_last_month").alias("total_bought"),
        F.count_if(F.col("is_best_seller")).alias("bestsellers"),
    )
    return top_k(per, "total_bought", k, asc, ["category_name"])


def category_totals(listings: DataFrame, categories: DataFrame) -> DataFrame:
    return with_category(listings, categories).agg(
        F.count_distinct("category_name").alias("total_categories"),
        F.sum("bought_last_month").alias("total_bought_all"),
    )


def tier_outcomes(listings: DataFrame) -> DataFrame:
    """Average sales, stars and badge rate by price tier, for priced listings."""
    tier = C.price_tier("price_cents", C.EDA_PRICE_TIERS, C.EDA_TOP_PRICE_TIER)
    priced = listings.where(F.col("price_cents") > 0).withColumn("price_tier", tier)
    return priced.groupBy("price_tier").agg(
        F.count(F.lit(1)).alias("products"),
        count_mean("bought_last_month").alias("avg_bought"),
        rating_mean("rating_tenths").alias("avg_stars"),
        pct(F.col("is_best_seller"), 2).alias("pct_bestseller"),
    )


def sales_power_law(listings: DataFrame) -> DataFrame:
    """How much of the catalogue and of all sales each sales tier holds."""
    per = listings.groupBy(C.sales_tier("bought_last_month").alias("sales_tier")).agg(
        F.count(F.lit(1)).alias("products"), F.sum("bought_last_month").alias("total_bought")
    )
    both = share_of_total(per, "products", "pct_of_catalog", 10)
    return share_of_total(both, "total_bought", "pct_of_revenue", 10)


# ---- subcategories --------------------------------------------------------------

def demand_density(landscape: DataFrame) -> DataFrame:
    """Revenue per listed product."""
    return landscape.withColumn("revenue_per_product", safe_ratio("total_revenue", "product_count"))


def competition(landscape: DataFrame) -> DataFrame:
    """Products per percent of active listings; higher is harder."""
    return landscape.withColumn("competition_score", safe_ratio("product_count", "pct_active"))


def hidden_gems(landscape: DataFrame, k: int = 15) -> DataFrame:
    """High revenue per product and activity against few competitors."""
    scored = demand_density(landscape).withColumn(
        "opportunity_score",
        F.try_divide(F.col("revenue_per_product") * F.col("pct_active"), F.col("product_count")),
    )
    return top_k(scored, "opportunity_score", k, tiebreak=["subcategory"])


# Weights of the opportunity score.
OPPORTUNITY_WEIGHTS = {
    "avg_revenue_per_product": 0.35, "pct_active": 0.25, "total_revenue": 0.20, "product_count": 0.20,
}
EPSILON = 1e-9  # fixed value: keeps a constant column from dividing by zero


def min_max(c: str, prefix: str = ""):
    lo, hi = F.col(f"{prefix}{c}_min"), F.col(f"{prefix}{c}_max")
    return (F.col(c) - lo) / (hi - lo + F.lit(EPSILON))


def opportunity_score(
    landscape: DataFrame, weights: dict[str, float] = OPPORTUNITY_WEIGHTS,
    min_revenue: float = 0, min_products: int = 0, n: int | None = 30,
) -> DataFrame:
    """Weighted score of min-max scaled factors; many products count against.

    All categories set the scale; the filters apply afterwards.
    """
    bounds = {}
    for c in weights:
        bounds[f"_{c}_min"], bounds[f"_{c}_max"] = F.min(c), F.max(c)
    scaled = with_scalars(landscape, **bounds)
    parts = {}
    for c in weights:
        unit = min_max(c, "_")
        parts[f"{c}_norm"] = (1 - unit) if c == "product_count" else unit
    scored = scaled.withColumns(parts)
    total = sum(F.col(f"{c}_norm") * w for c, w in weights.items()) * 100
    kept = scored.select(
        "subcategory", *weights, half_up(total, 10**6).alias("opportunity_score")
    ).where((F.col("total_revenue") >= min_revenue) & (F.col("product_count") >= min_products))
    return kept if n is None else top_k(kept, "opportunity_score", n, tiebreak=["subcategory"])


def category_typology(landscape: DataFrame) -> DataFrame:
    """Each subcategory as Star, Niche Premium, Volume Play or Graveyard, against the medians.

    The medians run over one row per subcategory.
    """
    dense = demand_density(landscape)
    split = with_scalars(
        dense, _rev=F.median("revenue_per_product"), _act=F.median("pct_active")
    )
    rich, busy = F.col("revenue_per_product") >= F.col("_rev"), F.col("pct_active") >= F.col("_act")
    kind = (
        F.when(rich & busy, "Star").when(rich, "Niche Premium").when(busy, "Volume Play")
        .otherwise("Graveyard")
    )
    return split.withColumn("category_type", kind).select(
        "subcategory", "revenue_per_product", "pct_active", "product_count", "total_revenue",
        "category_type",
    )


def typology_revenue(landscape: DataFrame) -> DataFrame:
    """Subcategories and revenue share per type."""
    per = category_typology(landscape).groupBy("category_type").agg(
        F.count(F.lit(1)).alias("subcategories"), F.sum(revenue_cents()).alias("_cents")
    )
    return share_of_total(per, "_cents", "revenue_share_pct", 10).select(
        "category_type", "subcategories", (F.col("_cents") / 100.0).alias("total_revenue"),
        "revenue_share_pct",
    )


# ---- trends ---------------------------------------------------------------------

def _yearly(trends: DataFrame, lo: int, hi: int) -> DataFrame:
    return trends.where(F.col("review_year").between(lo, hi)).groupBy(
        "source_category", "review_year"
    ).agg(
        F.sum("review_count").alias("review_count"), rated("avg_rating", 100).alias("avg_rating")
    )


def yearly_trend(trends: DataFrame, lo: int = 2018, hi: int = 2022) -> DataFrame:
    """Volume per year and its rating, weighted by category volume."""
    return _yearly(trends, lo, hi).groupBy("review_year").agg(
        F.sum("review_count").alias("total_reviews"),
        half_up(weighted_mean(minor("avg_rating"), "review_count") / 100, ROUND4).alias(
            "weighted_avg_rating"
        ),
    )


def yoy_growth(trends: DataFrame, lo: int = 2018, hi: int = 2022) -> DataFrame:
    """Change of yearly volume per category; years without reviews count as zero."""
    yearly = _yearly(trends, lo, hi).select("source_category", "review_year", "review_count")
    filled = (
        yearly.groupBy("source_category")
        .agg(F.map_from_entries(F.collect_list(F.struct("review_year", "review_count"))).alias("_by"))
        .select("source_category", "_by", F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("review_year"))
        .select(
            "source_category", F.col("review_year").cast("long").alias("review_year"),
            F.coalesce(F.try_element_at("_by", F.col("review_year").cast("long")), F.lit(0)).alias(
                "review_count"
            ),
        )
    )
    grown = R.pct_change(filled, ["source_category"], "review_year", "review_count", "growth_pct")
    return grown.where(F.col("review_year") > lo).withColumn("growth_pct", half_up("growth_pct", ROUND4))


def cagr(trends: DataFrame, lo: int = 2018, hi: int = 2022, k: int = 10) -> DataFrame:
    """Compound yearly growth from the first to the last year, slowest and fastest k."""
    volume = trends.where(F.col("review_year").isin(lo, hi)).groupBy("source_category").agg(
        F.coalesce(F.sum(F.when(F.col("review_year") == lo, F.col("review_count"))), F.lit(0)).alias("start_vol"),
        F.coalesce(F.sum(F.when(F.col("review_year") == hi, F.col("review_count"))), F.lit(0)).alias("end_vol"),
    )
    grown = volume.where(F.col("start_vol") > 0).withColumn(
        "cagr_pct",
        half_up((F.pow(F.col("end_vol") / F.col("start_vol"), F.lit(1.0 / (hi - lo))) - 1) * 100, ROUND4),
    )
    return extremes(grown, "cagr_pct", k, ["source_category"])


def period_shift(trends: DataFrame, recent: int = 2021, base: tuple[int, int] = (2018, 2020)) -> DataFrame:
    """Mean monthly volume and rating since ``recent`` against the base years, per category."""
    year = F.col("review_year")
    now, then = year >= recent, year.between(*base)

    def monthly(c, where):
        return F.avg(F.when(where, c))

    agg = trends.groupBy("source_category").agg(
        monthly(F.col("review_count"), now).alias("_now"),
        monthly(F.col("review_count"), then).alias("_then"),
        monthly(minor("avg_rating"), now).alias("_rnow"),
        monthly(minor("avg_rating"), then).alias("_rthen"),
    )
    return agg.select(
        "source_category",
        half_up((F.try_divide("_now", "_then") - 1) * 100, 10).alias("volume_change_pct"),
        half_up((F.col("_rnow") - F.col("_rthen")) / 100, 1000).alias("rating_shift"),
    ).where("volume_change_pct is not null and rating_shift is not null")


# ---- price and discount tiers ------------------------------------------------------

def _group_totals(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.sum(revenue_cents()).alias("_cents"), F.sum("product_count").alias("total_products")
    )


def _per_product():
    return safe_ratio(F.col("_cents") / 100.0, "total_products")


def group_totals(df: DataFrame, key: str) -> DataFrame:
    """Revenue, products and revenue per product by a label."""
    return _group_totals(df, key).select(
        key, (F.col("_cents") / 100.0).alias("total_revenue"), "total_products",
        _per_product().alias("rev_per_product"),
    )


def tier_totals(positioning: DataFrame) -> DataFrame:
    """Totals per price tier with its share of revenue, in tier order."""
    per = share_of_total(_group_totals(positioning, "price_tier"), "_cents", "rev_pct", 10)
    out = per.select(
        "price_tier", (F.col("_cents") / 100.0).alias("total_revenue"), "total_products",
        _per_product().alias("rev_per_product"), "rev_pct",
    )
    return sort_by_label(out, "price_tier", C.PRICE_TIER_ORDER)


def dominant(df: DataFrame, tier: str, measure: str = "total_revenue") -> DataFrame:
    """The tier with the largest measure in each subcategory."""
    return R.argmax_row(df.select("subcategory", tier, measure), ["subcategory"], measure, tier)


def tier_wins(df: DataFrame, tier: str, measure: str = "total_revenue") -> DataFrame:
    return value_counts(dominant(df, tier, measure), tier, "categories_won")


def tier_share(df: DataFrame, tier: str, k: int = 15) -> DataFrame:
    """How revenue splits over tiers in the k largest subcategories."""
    cents = df.select("subcategory", tier, revenue_cents().alias("_cents"))
    top = rows_of_top_groups(cents, "subcategory", F.sum("_cents"), k)
    shared = R.share_of_group(top, ["subcategory"], "_cents", "rev_share")
    return shared.select(
        "subcategory", tier, (F.col("_cents") / 100.0).alias("total_revenue"),
        half_up("rev_share", ROUND4).alias("rev_share"),
    )


def _with_density(df: DataFrame) -> DataFrame:
    return df.withColumn("rev_per_product", safe_ratio("total_revenue", "product_count"))


def tier_ratio(positioning: DataFrame, hi: str = "Luxury", lo: str = "Budget", k: int = 15) -> DataFrame:
    """Revenue per product of one tier over another, lowest and highest k, with its log2."""
    wide = pivot_labels(
        _with_density(positioning), "subcategory", "price_tier",
        {hi: "high_rev", lo: "low_rev"}, "rev_per_product",
    )
    ratio = wide.withColumn("ratio", safe_ratio("high_rev", "low_rev")).where("ratio is not null")
    both = extremes(ratio, "ratio", k, ["subcategory"]).where(F.col("ratio") > 0)
    return both.select(
        "subcategory", half_up("ratio", ROUND4).alias("ratio"),
        half_up(F.log2("ratio"), ROUND4).alias("log2_ratio"),
    )


def tier_rating(positioning: DataFrame) -> DataFrame:
    """Mean of the subcategories' mean ratings per tier."""
    return positioning.groupBy("price_tier").agg(
        half_up(F.sum(minor("avg_rating")) / F.count("avg_rating") / 100, ROUND4).alias("avg_rating"),
        F.sum("product_count").alias("total_products"),
    )


def discount_curve(discounts: DataFrame) -> DataFrame:
    return sort_by_label(group_totals(discounts, "discount_tier"), "discount_tier", C.DISCOUNT_TIER_ORDER)


def discounted_vs_full(discounts: DataFrame) -> DataFrame:
    """Everything with a discount against everything without."""
    label = F.when(F.col("discount_tier") == C.NO_DISCOUNT, "Full Price").otherwise("Discounted")
    return group_totals(discounts.withColumn("label", label), "label")


def sweet_spot(positioning: DataFrame, k: int = 4) -> DataFrame:
    """Revenue per product by tier in the k largest subcategories."""
    top = rows_of_top_groups(positioning, "subcategory", F.sum(revenue_cents()), k)
    return _with_density(top).select("subcategory", "price_tier", "rev_per_product")


# ---- brands and listings -------------------------------------------------------------

def brand_totals(brands: DataFrame) -> DataFrame:
    return group_totals(brands, "brand_status")


def brand_multiplier(brands: DataFrame, k: int = 15) -> DataFrame:
    """Branded over unbranded revenue per product, lowest and highest k."""
    wide = pivot_labels(
        _with_density(brands), "subcategory", "brand_status",
        {"Branded": "branded", "Unbranded": "unbranded"}, "rev_per_product",
    )
    ratio = wide.withColumn("brand_multiplier", safe_ratio("branded", "unbranded"))
    both = extremes(ratio, "brand_multiplier", k, ["subcategory"]).where(F.col("brand_multiplier") > 0)
    return both.select(
        "subcategory", half_up("brand_multiplier", ROUND4).alias("brand_multiplier"),
        half_up(F.log2("brand_multiplier"), ROUND4).alias("log2_multiplier"),
    )


def brand_presence(brands: DataFrame, k: int = 20) -> DataFrame:
    """Share of branded products, least and most branded k subcategories."""
    wide = pivot_labels(
        brands, "subcategory", "brand_status",
        {"Branded": "branded", "Unbranded": "unbranded"}, "product_count",
    ).na.fill(0, ["branded", "unbranded"])
    share = wide.withColumn(
        "branded_pct", rounded("branded", F.col("branded") + F.col("unbranded"), 1000, 10)
    )
    return extremes(share, "branded_pct", k, ["subcategory"])


LISTING_ELEMENTS = {
    "Features": ("avg_rev_with_features", "avg_rev_without_features"),
    "Description": ("avg_rev_with_description", "avg_rev_without_description"),
    "Brand": ("avg_rev_with_brand", "avg_rev_without_brand"),
    "High Completeness": ("avg_rev_high_completeness", "avg_rev_low_completeness"),
}


def element_multipliers(quality: DataFrame) -> DataFrame:
    """Median over subcategories of revenue with an element over revenue without it."""
    ratios = quality.select(*[
        safe_ratio(a, b).alias(name) for name, (a, b) in LISTING_ELEMENTS.items()
    ])
    long = ratios.unpivot([], list(LISTING_ELEMENTS), "element", "ratio")
    return long.groupBy("element").agg(half_up(F.median("ratio"), ROUND4).alias("median_multiplier"))


def completeness_leaders(quality: DataFrame, k: int = 20) -> DataFrame:
    ratio = quality.select(
        "subcategory",
        safe_ratio("avg_rev_high_completeness", "avg_rev_low_completeness").alias("completeness_multiplier"),
    )
    return top_k(ratio, "completeness_multiplier", k, tiebreak=["subcategory"])


def badge_leaders(bestsellers: DataFrame, k: int = 20) -> DataFrame:
    cols = bestsellers.select("subcategory", "bestseller_revenue_multiplier")
    return top_k(cols, "bestseller_revenue_multiplier", k, tiebreak=["subcategory"])


def badge_rates(bestsellers: DataFrame, above: float = 5) -> DataFrame:
    """Median badge rate and how many subcategories lie above a rate."""
    return bestsellers.agg(
        half_up(F.median(minor("pct_bestsellers")) / 100, ROUND4).alias("median_badge_rate"),
        F.count_if(F.col("pct_bestsellers") > above).alias("categories_above"),
    )


SIGNALS = [
    "rev_per_product", "pct_with_brand", "pct_with_features", "pct_with_description",
    "pct_with_store", "pct_best_sellers", "avg_rating", "avg_reviews", "pct_active",
]


def coverage_correlations(landscape: DataFrame) -> DataFrame:
    """Correlation of each listing part's coverage with revenue per product."""
    df = _with_density(landscape)
    parts = ["brand", "features", "description", "store"]
    one = df.agg(*[corr_pair(df, f"pct_with_{p}", "rev_per_product").alias(p) for p in parts])
    return one.unpivot([], parts, "element", "corr")


def signal_correlations(landscape: DataFrame) -> DataFrame:
    return corr_matrix(_with_density(landscape), SIGNALS)


def with_activity(badges: DataFrame, landscape: DataFrame) -> DataFrame:
    """Badge table with the subcategory's activity rate; the null subcategory matches itself."""
    return R.null_safe_join(badges, landscape.select("subcategory", "pct_active"), ["subcategory"])


def badge_vs_activity(badges: DataFrame, landscape: DataFrame) -> DataFrame:
    return with_activity(badges, landscape).select("subcategory", "pct_bestsellers", "pct_active")


def listing_lift(quality: DataFrame) -> DataFrame:
    """Lift of revenue with each listing part over without, in percent; 0 without a base."""
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("element"),
            F.coalesce(F.col(a), F.lit(0.0)).alias("with_part"),
            F.coalesce(F.col(b), F.lit(0.0)).alias("without_part"),
        )
        for name, (a, b) in list(LISTING_ELEMENTS.items())[:3]
    ])
    long = quality.select("subcategory", F.explode(rows).alias("_r")).select("subcategory", "_r.*")
    lift = (F.try_divide("with_part", "without_part") - 1) * 100
    return long.withColumn(
        "lift_pct", F.when(F.col("without_part") > 0, half_up(lift, ROUND4)).otherwise(0.0)
    )


def product_vs_category(products: DataFrame, landscape: DataFrame, asin: str) -> DataFrame:
    """One product's price, rating, reviews and revenue against its subcategory's means."""
    mine = products.where(F.col("asin") == asin)
    both = R.null_safe_join(
        mine.select("asin", "subcategory", "price_cents", "rating_tenths", "review_count", "revenue_cents"),
        landscape.select("subcategory", "avg_price", "avg_rating", "avg_reviews", "avg_revenue_per_product"),
        ["subcategory"], "inner",
    )
    pairs = [
        ("Price", F.col("price_cents") / 100.0, "avg_price"),
        ("Rating", F.col("rating_tenths") / 10.0, "avg_rating"),
        ("Reviews", F.col("review_count").cast("double"), "avg_reviews"),
        ("Revenue/Product", F.col("revenue_cents") / 100.0, "avg_revenue_per_product"),
    ]
    rows = F.array(*[
        F.struct(
            F.lit(n).alias("metric"), F.coalesce(own, F.lit(0.0)).alias("product"),
            F.coalesce(F.col(avg), F.lit(0.0)).alias("category_avg"),
        )
        for n, own, avg in pairs
    ])
    long = both.select("asin", F.explode(rows).alias("_r")).select("asin", "_r.*")
    diff = half_up((F.try_divide("product", "category_avg") - 1) * 100, 10)
    return long.withColumn(
        "difference_pct", F.when(F.col("category_avg") > 0, diff).otherwise(0.0)
    )


# ---- stores -----------------------------------------------------------------------------

def store_size_stats(stores: DataFrame) -> DataFrame:
    """Stores, share with one product, and median, largest and 99th percentile of listed products."""
    agg = stores.agg(
        F.count(F.lit(1)).alias("stores"),
        pct(F.col("listed_products") == 1).alias("pct_single_product"),
        F.max("listed_products").alias("max_products"),
    )
    return R.with_quantiles(agg, stores, [], {
        "median_products": ("listed_products", 0.5, 100, 1),
        "p99_products": ("listed_products", 0.99, 100, 1),
    })


def _mean_of(c: str, per_unit: int = 100):
    """Mean of a rounded column, to four decimals."""
    return half_up(F.sum(minor(c, per_unit)) / F.count(c) / per_unit, ROUND4)


def store_size_tiers(stores: DataFrame) -> DataFrame:
    """Stores and revenue by store size, with each tier's share of both."""
    per = stores.withColumn("size_tier", C.size_tier("listed_products")).groupBy("size_tier").agg(
        F.count(F.lit(1)).alias("store_count"),
        F.sum(revenue_cents()).alias("_cents"),
        _mean_of("avg_revenue_per_product").alias("avg_rev_per_product"),
        half_up(F.avg("listed_products"), ROUND4).alias("avg_products"),
    )
    shared = share_of_total(per, "store_count", "pct_stores", ROUND4)
    return share_of_total(shared, "_cents", "pct_revenue", ROUND4).withColumn(
        "total_revenue", F.col("_cents") / 100.0
    ).drop("_cents")


def store_type_stats(stores: DataFrame) -> DataFrame:
    per = stores.groupBy("store_type").agg(
        F.count(F.lit(1)).alias("store_count"),
        _mean_of("avg_revenue_per_product").alias("avg_rev_per_product"),
        total_money(revenue_cents()).alias("total_revenue"),
        half_up(F.avg("listed_products"), ROUND4).alias("avg_products"),
        _mean_of("avg_rating").alias("avg_rating"),
    )
    return share_of_total(per, "store_count", "pct_stores", ROUND4)


def diversification(stores: DataFrame, up_to: int = 10) -> DataFrame:
    """Stores and their revenue per product by number of categories sold in."""
    return stores.where(F.col("category_count") <= up_to).groupBy("category_count").agg(
        F.count(F.lit(1)).alias("store_count"),
        _mean_of("avg_revenue_per_product").alias("avg_rev_per_product"),
        half_up(F.avg("listed_products"), ROUND4).alias("avg_products"),
    )


def concentration(stores: DataFrame) -> DataFrame:
    """Stores by falling revenue with running shares."""
    cents = stores.select("store", revenue_cents().alias("cents"))
    return R.concentration_curve(cents, "cents", "store")


def concentration_summary(stores: DataFrame) -> DataFrame:
    return R.concentration_summary(stores.select(revenue_cents().alias("cents")), "cents")


def _earning_rated(stores: DataFrame) -> DataFrame:
    return stores.where((F.col("avg_rating") > 0) & (F.col("avg_revenue_per_product") > 0))


def rating_vs_revenue(stores: DataFrame) -> DataFrame:
    """Revenue per product by store rating, for rated stores that earn."""
    df = _earning_rated(stores).select(
        C.rating_bin(minor("avg_rating")).alias("rating_bin"),
        minor("avg_revenue_per_product").alias("cents"),
    )
    agg = df.groupBy("rating_bin").agg(
        F.count(F.lit(1)).alias("store_count"), mean("cents", 1, 100).alias("avg_rev")
    )
    return R.with_quantiles(agg, df, ["rating_bin"], {"median_rev": ("cents", 0.5, 1, 100)})


def rating_revenue_corr(stores: DataFrame) -> DataFrame:
    df = _earning_rated(stores)
    return df.agg(corr_pair(df, "avg_rating", "avg_revenue_per_product").alias("corr"))


def trim_stores(stores: DataFrame, q: float = 0.99) -> DataFrame:
    """Earning stores without the extreme sizes and revenues."""
    df = stores.select(
        "store", "store_type", "listed_products", minor("avg_revenue_per_product").alias("cents")
    )
    return trim_upper(df, ["listed_products", "cents"], q).where(F.col("cents") > 0)


# ---- trust scores -----------------------------------------------------------------------

TRUST_FEATURES = [
    "reviews_per_day", "verified_rate", "extreme_ratio", "text_rate", "short_text_rate",
    "reviews_per_reviewer", "unverified_5star_gap", "pct_5star", "pct_1star", "avg_text_length",
    "reviews_per_month", "pct_with_helpful_votes",
]


def anomaly_by_category(scores: DataFrame, k: int | None = 20) -> DataFrame:
    """Flagged share and mean trust per source category, most flagged first."""
    per = scores.groupBy("source_category").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_suspicious").alias("anomalies"),
        _mean_of("trust_score", 10).alias("avg_trust"),
        pct(F.col("is_suspicious")).alias("anomaly_rate"),
    )
    return per if k is None else top_k(per, "anomaly_rate", k, tiebreak=["source_category"])


def top_suspicious(scores: DataFrame, k: int = 20) -> DataFrame:
    flagged = scores.where("is_suspicious")
    return top_k(flagged, "trust_score", k, asc=True, tiebreak=["parent_asin", "source_category"])


def suspicious_deviation(scores: DataFrame, features: list[str], k: int = 20) -> DataFrame:
    """Feature means of the k least trusted flagged products against normal ones, in percent."""
    worst = top_suspicious(scores, k).agg(*[F.avg(f).alias(f) for f in features])
    normal = scores.where("not is_suspicious").agg(*[F.avg(f).alias(f) for f in features])
    long = concat(
        worst.unpivot([], features, "feature", "value").withColumn("side", F.lit("worst")),
        normal.unpivot([], features, "feature", "value").withColumn("side", F.lit("normal")),
    )
    wide = pivot_labels(long, "feature", "side", {"worst": "worst", "normal": "normal"}, "value")
    return wide.withColumn("deviation_pct", (F.try_divide("worst", "normal") - 1) * 100)


def trust_tiers(scores: DataFrame) -> DataFrame:
    return scores.groupBy(C.trust_tier("trust_score").alias("trust_tier")).agg(
        F.count(F.lit(1)).alias("products")
    )


def success_by_quintile(df: DataFrame, feature: str, label: str = "is_success", n: int = 5) -> DataFrame:
    """Success rate in each quantile bucket of an integer feature."""
    cut = R.quantile_buckets(df.select(feature, label), feature, n)
    return cut.where(F.col("bucket").isNotNull()).groupBy("bucket", "bucket_low", "bucket_high").agg(
        F.count(F.lit(1)).alias("products"),
        half_up(F.sum(label) / F.count(F.lit(1)), ROUND4).alias("success_rate"),
    )
