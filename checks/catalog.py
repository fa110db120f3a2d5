"""Every registered query with its SQL, by inventory id.

``@entry(name, sql)`` registers a function of a market (and, where it needs
them, the session and folder).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import sql as S
from mercata import roles, schemas
from mercata.functions import columns as C
from mercata.functions import exact as E
from mercata.market import Market
from mercata.ml import anomalies, attributions, clusters, models, success
from mercata.operators import ranks, sketches
from mercata.operators import relational as rel
from mercata.plans import gold_products as gp
from mercata.plans import gold_reviews as gr
from mercata.plans import analysis, quality, serving, silver
from mercata.session import folder_exists, scratch_path, tune
from mercata.sources import readers, tables
from mercata.streaming import summaries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def entry(name: str, sql: str | None = None, **extra: str):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        def run(spark, sf_dir):
            market = roles.market(tune(spark), sf_dir)
            market.origin = (spark.sparkContext.applicationId, sf_dir)
            return fn(market)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = S.query(sql, **extra)
        return fn

    return add


_STORED: dict = {}


def once(m: Market, name: str, make):
    """What several model queries share is made once per application and folder,
    as a pipeline would store it, instead of once per query."""
    key = (*m.origin, name)
    if key not in _STORED:
        _STORED[key] = make()
    return _STORED[key]


def stored(m: Market, name: str) -> DataFrame:
    """A table of the market, written to the shared folder once."""
    return once(m, name, lambda: clusters.checkpointed(getattr(m, name)))


def with_facts(m: Market) -> Market:
    """The market with the facts of its reviews already written: summaries, trust and its users read them once each."""
    def make():
        facts = m.review_facts.sortWithinPartitions(*gr.PRODUCT)  # rows of a product combine, and take less room
        return tables.materialize(facts, scratch_path(facts.sparkSession, "review-facts"))

    m.__dict__["review_facts"] = once(m, "review_facts", make)
    return m


def trust_signals(m: Market) -> DataFrame:
    with_facts(m)
    return anomalies.trust_features(m.product_review_trust, m.product_review_summary)


def trust_scores(m: Market) -> DataFrame:
    return stored(with_facts(m), "product_trust_scores")


def raw_entry(name: str, sql: str | None = None, **extra: str):
    """For operators that start from files: the function gets (spark, sf_dir)."""
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
        if sql is not None:
            ORACLE[name] = S.query(sql, **extra)
        return fn

    return add


# ---- tables -------------------------------------------------------------------

PRODUCT_COLS = (
    "asin, subcategory, main_category, title, price_cents / 100.0 AS price, "
    "list_cents / 100.0 AS list_price, discount_tenths / 10.0 AS discount_pct, "
    "rating_tenths / 10.0 AS rating, review_count, is_best_seller, bought_last_month, "
    "revenue_cents / 100.0 AS estimated_revenue, price_tier, store, brand, manufacturer, features, "
    "description, metadata_categories, title_length, has_features, has_description, has_store, "
    "has_brand, is_matched, flag_no_price, flag_no_reviews, flag_no_sales, flag_no_rating, flag_no_title"
)


@entry("G1_silver_products", f"SELECT {PRODUCT_COLS} FROM products")
def _(m: Market):
    return silver.present_products(m.products)


@entry("G2_silver_products_full", """SELECT * EXCLUDE (price_cents, rating_tenths),
  price_cents / 100.0 AS price, rating_tenths / 10.0 AS rating FROM products_full""")
def _(m):
    return silver.present_products_full(m.products_full)


@entry("G5_silver_reviews", "SELECT * EXCLUDE (doc_id) FROM reviews")
def _(m):
    return m.reviews


for _id, _name in [
    ("G3", "category_profile"), ("G4", "stores"), ("G6", "subcategory_landscape"),
    ("G7", "main_category_landscape"), ("G8", "price_positioning"), ("G9", "brand_dynamics"),
    ("G10", "discount_effectiveness"), ("G11", "listing_quality"), ("G12", "bestseller_analysis"),
    ("G13", "product_benchmarks"), ("G14", "category_benchmarks_full"), ("G15", "store_performance"),
    ("G16", "product_review_summary"), ("G17", "product_review_trust"), ("G18", "review_trust"),
    ("G19", "review_sentiment"), ("G20", "temporal_trends"), ("G21", "review_keywords"),
]:
    entry(f"{_id}_{_name}", f"SELECT * FROM {_name}")(lambda m, n=_name: getattr(m, n))


@raw_entry("G21_review_keywords_whole_text", S.keywords("documents", "doc_id", "text"))
def _(spark, sf_dir):
    texts = roles.review_texts(spark, sf_dir).withColumnRenamed("doc_id", "text_id")
    return gr.review_keywords(roles.review_references(spark, sf_dir), "text_id", texts=texts)


# ---- reports over the tables ----------------------------------------------------

def top(sql: str, c: str, k: int, *ties: str, asc: bool = False) -> str:
    """The k largest (smallest) rows of a statement."""
    order = ", ".join([f"{c} {'ASC' if asc else 'DESC'}", *ties])
    return f"SELECT * FROM ({sql}) WHERE {c} IS NOT NULL ORDER BY {order} LIMIT {k}"


def both_ends(sql: str, c: str, k: int, tie: str) -> str:
    return f"({top(sql, c, k, tie, asc=True)}) UNION ALL ({top(sql, c, k, tie)})"


WIDE_BRANDS = """SELECT subcategory,
  max(avg_revenue_per_product) FILTER (WHERE brand_status = 'Branded') AS branded_rev,
  max(avg_revenue_per_product) FILTER (WHERE brand_status = 'Unbranded') AS unbranded_rev
  FROM brand_dynamics GROUP BY subcategory"""


@entry("G22_A13_brand_multiplier_top", top(
    f"SELECT *, {S.half_up('branded_rev / unbranded_rev', 10)} AS brand_multiplier "
    f"FROM ({WIDE_BRANDS}) WHERE branded_rev IS NOT NULL AND unbranded_rev > 0",
    "brand_multiplier", 10, "subcategory"))
def _(m):
    return gp.brand_multiplier_top(m.brand_dynamics)


@entry("G23_completeness_top", top(
    "SELECT subcategory, avg_completeness_score, avg_rev_high_completeness, avg_rev_low_completeness, "
    + S.half_up("avg_rev_high_completeness / avg_rev_low_completeness", 10)
    + " AS completeness_multiplier FROM listing_quality WHERE avg_rev_low_completeness > 0",
    "completeness_multiplier", 5, "subcategory"))
def _(m):
    return gp.completeness_top(m.listing_quality)


@entry("G24_badge_top", top(
    "SELECT subcategory, bestseller_count, pct_bestsellers, avg_rev_bestseller, avg_rev_non_bestseller, "
    "bestseller_revenue_multiplier FROM bestseller_analysis WHERE bestseller_count >= 2",
    "bestseller_revenue_multiplier", 5, "subcategory"))
def _(m):
    return gp.badge_top(m.bestseller_analysis, min_badges=2)


GAP = (
    "SELECT source_category, pct_verified, pct_5star_among_unverified, pct_5star_among_verified, "
    + S.half_up("pct_5star_among_unverified - pct_5star_among_verified", 10)
    + " AS unverified_5star_gap FROM review_trust"
)


@entry("G25_unverified_gap", top(GAP, "unverified_5star_gap", 5, "source_category"))
def _(m):
    return gr.unverified_gap(m.review_trust)


@entry("G26_most_suspicious", """SELECT parent_asin, source_category, review_count, pct_extreme_ratings,
  pct_verified, pct_very_short_text, reviews_per_day FROM product_review_trust WHERE review_count >= 20
  ORDER BY pct_extreme_ratings DESC, pct_verified, parent_asin, source_category LIMIT 5""")
def _(m):
    return gr.most_suspicious(m.product_review_trust, min_reviews=20)


@entry("G27_A12_store_type_performance", f"""SELECT store_type, count(*) AS stores,
  {S.rated('avg_revenue_per_product', 100)} AS avg_rev_per_product,
  {S.rated('pct_active', 10)} AS avg_pct_active FROM store_performance GROUP BY store_type""")
def _(m):
    return gp.store_type_performance(m.store_performance)


@entry("G28_A12_yearly_volume", f"""SELECT review_year, {S.big('sum(review_count)')} AS total_reviews,
  {S.rated('avg_rating', 100)} AS avg_rating FROM temporal_trends WHERE review_year >= 1998
  GROUP BY review_year""")
def _(m):
    return gr.yearly_volume(m.temporal_trends, 1998)


@entry("G29_match_rate", f"""SELECT subcategory, product_count, products_with_reviews,
  {S.ratio('products_with_reviews', 'product_count', 1000, 10)} AS pct_matched
  FROM category_benchmarks_full""")
def _(m):
    return gp.match_rate(m.category_benchmarks_full)


@entry("G30_enrichment_coverage", f"""SELECT count(*) AS total, {S.big('sum(is_matched)')} AS enriched,
  {S.pct('is_matched = 1')} AS pct_enriched,
  count(*) FILTER (WHERE list_cents > 0) AS has_list_price,
  count(*) FILTER (WHERE is_best_seller) AS bestsellers,
  {S.big('sum(has_features)')} AS has_features, {S.big('sum(has_description)')} AS has_description,
  count(title) AS has_title FROM products""")
def _(m):
    return gp.enrichment_coverage(m.products)


@entry("G31_most_negative", top(
    "SELECT source_category, pct_negative, avg_text_length_negative, negative_verbosity_ratio, "
    "avg_helpful_negative FROM review_sentiment", "pct_negative", 5, "source_category"))
def _(m):
    return gr.most_negative(m.review_sentiment)


@entry("G32_leaderboard_subcategories",
       top("SELECT subcategory, total_revenue, pct_active FROM subcategory_landscape",
           "total_revenue", 5, "subcategory"))
def _(m):
    df = m.subcategory_landscape.select("subcategory", "total_revenue", "pct_active")
    return gp.leaderboard(df, "total_revenue", 5, key=["subcategory"])


@entry("G32_leaderboard_main_categories",
       top("SELECT main_category, total_revenue, ecosystem_products FROM main_category_landscape",
           "total_revenue", 5, "main_category"))
def _(m):
    df = m.main_category_landscape.select("main_category", "total_revenue", "ecosystem_products")
    return gp.leaderboard(df, "total_revenue", 5, key=["main_category"])


@entry("G32_leaderboard_most_reviewed",
       top("SELECT * FROM product_review_summary", "review_count", 5, "parent_asin", "source_category"))
def _(m):
    return gp.leaderboard(m.product_review_summary, "review_count", 5, key=["parent_asin", "source_category"])


SUB = "Brand#7"


@entry("G33_lookup_price_tiers", f"""SELECT price_tier, product_count, total_revenue,
  avg_revenue_per_product, pct_active FROM price_positioning WHERE subcategory = '{SUB}'""")
def _(m):
    cols = ["price_tier", "product_count", "total_revenue", "avg_revenue_per_product", "pct_active"]
    return gp.lookup(m.price_positioning, {"subcategory": SUB}, [F.desc("total_revenue")]).select(*cols)


@entry("G33_lookup_discounts", f"""SELECT discount_tier, product_count, total_revenue,
  avg_revenue_per_product, pct_active FROM discount_effectiveness WHERE subcategory = '{SUB}'""")
def _(m):
    cols = ["discount_tier", "product_count", "total_revenue", "avg_revenue_per_product", "pct_active"]
    return gp.lookup(m.discount_effectiveness, {"subcategory": SUB}, [F.desc("total_revenue")]).select(*cols)


@entry("G33_lookup_benchmark", f"""SELECT price_p25, price_p50, price_p75, reviews_p25, reviews_p50,
  reviews_p75, sales_p50 FROM product_benchmarks WHERE subcategory = '{SUB}'""")
def _(m):
    return gp.lookup(m.product_benchmarks, {"subcategory": SUB}).select(
        "price_p25", "price_p50", "price_p75", "reviews_p25", "reviews_p50", "reviews_p75", "sales_p50"
    )


WORDS = "SELECT word, word_count FROM review_keywords WHERE source_category = 'PROMO' AND sentiment = '{}'"


@entry("G33_lookup_words", top(WORDS.format("negative"), "word_count", 10, "word"))
def _(m):
    return gp.lookup(
        m.review_keywords, {"source_category": "PROMO", "sentiment": "negative"},
        [F.desc("word_count"), "word"], 10,
    ).select("word", "word_count")


@entry("G34_W3_W4_taxonomy_agreement", top("""
  SELECT subcategory, main_category, cnt, floor(cnt * 100.0 / total * 10 + 0.5) / 10.0 AS pct FROM (
    SELECT *, sum(cnt) OVER (PARTITION BY subcategory) AS total,
      row_number() OVER (PARTITION BY subcategory ORDER BY cnt DESC, main_category DESC) AS rn
    FROM (SELECT subcategory, main_category, count(*) AS cnt FROM products
          WHERE main_category IS NOT NULL GROUP BY subcategory, main_category)) WHERE rn = 1""",
    "pct", 20, "subcategory", asc=True))
def _(m):
    return gp.taxonomy_agreement(m.products)


@entry("N32_distinctive_keywords", f"""
  SELECT word, own_count, other_count, {S.half_up('own_count / other_count', 100)} AS ratio FROM (
    SELECT word, {S.big("sum(word_count) FILTER (WHERE sentiment = 'negative')")} AS own_count,
      {S.big("sum(word_count) FILTER (WHERE sentiment = 'positive')")} AS other_count
    FROM review_keywords GROUP BY word) WHERE own_count IS NOT NULL AND other_count IS NOT NULL""")
def _(m):
    return gr.distinctive_keywords(m.review_keywords)


@entry("N32_distinctive_praise", top(f"""
  SELECT word, own_count, other_count, {S.half_up('own_count / other_count', 100)} AS ratio FROM (
    SELECT word, {S.big("sum(word_count) FILTER (WHERE sentiment = 'positive')")} AS own_count,
      {S.big("sum(word_count) FILTER (WHERE sentiment = 'negative')")} AS other_count
    FROM review_keywords GROUP BY word)""", "ratio", 20, "word"))
def _(m):
    return gr.distinctive_keywords(m.review_keywords, "positive", 20)


# ---- reports over listings, trends, tiers, brands, stores ---------------------------

A = analysis
LO, HI = roles.WINDOW


@entry("N1_A21_profile_nulls", """SELECT count(*) AS total,
  count(*) FILTER (WHERE price_cents IS NULL) AS null_price_cents,
  count(*) FILTER (WHERE rating_tenths IS NULL) AS null_rating_tenths,
  count(*) FILTER (WHERE review_count IS NULL) AS null_review_count,
  count(*) FILTER (WHERE bought_last_month IS NULL) AS null_bought_last_month,
  count(*) FILTER (WHERE title IS NULL OR title = '') AS null_title,
  count(*) FILTER (WHERE review_count = 0) AS zero_review_count,
  count(*) FILTER (WHERE bought_last_month = 0) AS zero_bought_last_month,
  count(*) FILTER (WHERE price_cents = 0) AS zero_price_cents FROM listings""")
def _(m):
    return A.profile_nulls(
        m.listings,
        ["price_cents", "rating_tenths", "review_count", "bought_last_month", "title"],
        ["review_count", "bought_last_month", "price_cents"],
    )


@entry("N1_profile_nulls_metadata", "SELECT count(*) AS total, " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL OR {c} = '') AS null_{c}"
    for c in ("store", "features", "description", "details_brand", "details_manufacturer")
) + " FROM metadata")
def _(m):
    return A.profile_nulls(
        m.metadata, ["store", "features", "description", "details_brand", "details_manufacturer"]
    )


@entry("N2_A1_A3_profile_numeric", f"""SELECT min(price_cents) / 100.0 AS min_price,
  floor(median(price_cents) + 0.5) / 100.0 AS median_price, {S.money('price_cents')} AS avg_price,
  max(price_cents) / 100.0 AS max_price, min(rating_tenths) / 10.0 AS min_stars,
  {S.mean('rating_tenths', 1, 10)} AS avg_stars, max(rating_tenths) / 10.0 AS max_stars,
  max(review_count) AS max_reviews, max(bought_last_month) AS max_bought,
  count(*) FILTER (WHERE is_best_seller) AS bestseller_count FROM listings""")
def _(m):
    return A.profile_numeric(m.listings)


DEMAND = f"""SELECT category_name, count(*) AS products, {S.money('price_cents')} AS avg_price,
  {S.stars10('rating_tenths')} AS avg_stars, count(*) FILTER (WHERE review_count > 0) AS has_reviews,
  {S.pct('review_count > 0')} AS pct_with_reviews, {S.big('sum(bought_last_month)')} AS total_bought,
  count(*) FILTER (WHERE is_best_seller) AS bestsellers
  FROM listings JOIN categories ON category_id = id GROUP BY category_name"""


@entry("N3_J8_category_demand", top(DEMAND, "total_bought", 20, "category_name"))
def _(m):
    return A.category_demand(m.listings, m.categories)


@entry("N3_J8_category_demand_bottom", top(DEMAND, "total_bought", 20, "category_name", asc=True))
def _(m):
    return A.category_demand(m.listings, m.categories, asc=True)


@entry("N3_A2_category_totals", f"""SELECT count(DISTINCT category_name) AS total_categories,
  {S.big('sum(bought_last_month)')} AS total_bought_all
  FROM listings JOIN categories ON category_id = id""")
def _(m):
    return A.category_totals(m.listings, m.categories)


@entry("N4_P9_tier_outcomes", f"""SELECT CASE WHEN price_cents >= 10000 THEN '5. $100+'
    WHEN price_cents >= 5000 THEN '4. $50-100' WHEN price_cents >= 2500 THEN '3. $25-50'
    WHEN price_cents >= 1000 THEN '2. $10-25' ELSE '1. Under $10' END AS price_tier,
  count(*) AS products, {S.whole('bought_last_month')} AS avg_bought,
  {S.stars10('rating_tenths')} AS avg_stars, {S.pct('is_best_seller', 2)} AS pct_bestseller
  FROM listings WHERE price_cents > 0 GROUP BY ALL""")
def _(m):
    return A.tier_outcomes(m.listings)


@entry("N4_P19_W5_sales_power_law", """SELECT sales_tier, products, total_bought,
  floor(products * 100.0 / sum(products) OVER () * 10 + 0.5) / 10.0 AS pct_of_catalog,
  floor(total_bought * 100.0 / sum(total_bought) OVER () * 10 + 0.5) / 10.0 AS pct_of_revenue
  FROM (SELECT CASE WHEN bought_last_month >= 5000 THEN '5. 5000+'
      WHEN bought_last_month >= 500 THEN '4. 500-4999' WHEN bought_last_month >= 50 THEN '3. 50-499'
      WHEN bought_last_month >= 1 THEN '2. 1-49' ELSE '1. Zero sales' END AS sales_tier,
    count(*) AS products, CAST(sum(bought_last_month) AS BIGINT) AS total_bought
    FROM listings GROUP BY ALL)""")
def _(m):
    return A.sales_power_law(m.listings)


@entry("N5_demand_density",
       "SELECT *, total_revenue / nullif(product_count, 0) AS revenue_per_product FROM subcategory_landscape")
def _(m):
    return A.demand_density(m.subcategory_landscape)


@entry("N6_competition", "SELECT *, product_count / nullif(pct_active, 0) AS competition_score FROM subcategory_landscape")
def _(m):
    return A.competition(m.subcategory_landscape)


@entry("N7_hidden_gems", top("""SELECT *, revenue_per_product * pct_active / product_count AS opportunity_score
  FROM (SELECT *, total_revenue / nullif(product_count, 0) AS revenue_per_product FROM subcategory_landscape)""",
    "opportunity_score", 15, "subcategory"))
def _(m):
    return A.hidden_gems(m.subcategory_landscape)


def _unit(c):
    return f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + CAST(1e-9 AS DOUBLE))"


@entry("N8_J11_opportunity_score", top(f"""SELECT * FROM (
  SELECT subcategory, avg_revenue_per_product, pct_active, total_revenue, product_count,
    floor(({_unit('avg_revenue_per_product')} * CAST(0.35 AS DOUBLE) + {_unit('pct_active')} * CAST(0.25 AS DOUBLE)
      + {_unit('total_revenue')} * CAST(0.20 AS DOUBLE) + (1 - {_unit('product_count')}) * CAST(0.20 AS DOUBLE)) * 100
      * 1000000 + 0.5) / 1000000.0 AS opportunity_score
  FROM subcategory_landscape) WHERE total_revenue >= 1000 AND product_count >= 10""",
    "opportunity_score", 20, "subcategory"))
def _(m):
    return A.opportunity_score(m.subcategory_landscape, min_revenue=1000, min_products=10, n=20)


TYPOLOGY = """SELECT subcategory, revenue_per_product, pct_active, product_count, total_revenue,
  CASE WHEN revenue_per_product >= med_rev THEN if(pct_active >= med_act, 'Star', 'Niche Premium')
    ELSE if(pct_active >= med_act, 'Volume Play', 'Graveyard') END AS category_type
  FROM (SELECT *, median(revenue_per_product) OVER () AS med_rev, median(pct_active) OVER () AS med_act
    FROM (SELECT *, total_revenue / nullif(product_count, 0) AS revenue_per_product
          FROM subcategory_landscape))"""


@entry("N9_P23_category_typology", TYPOLOGY)
def _(m):
    return A.category_typology(m.subcategory_landscape)


@entry("N9_W5_typology_revenue", f"""SELECT category_type, subcategories, cents / 100.0 AS total_revenue,
  floor(cents * 100.0 / sum(cents) OVER () * 10 + 0.5) / 10.0 AS revenue_share_pct
  FROM (SELECT category_type, count(*) AS subcategories,
          CAST(sum(CAST(round(total_revenue * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM ({TYPOLOGY}) GROUP BY category_type)""")
def _(m):
    return A.typology_revenue(m.subcategory_landscape)


YEARLY = f"""SELECT source_category, review_year, CAST(sum(review_count) AS BIGINT) AS review_count,
  {S.rated('avg_rating', 100)} AS avg_rating FROM temporal_trends
  WHERE review_year BETWEEN {LO} AND {HI} GROUP BY ALL"""


@entry("N10_A15_yearly_trend", f"""SELECT review_year, CAST(sum(review_count) AS BIGINT) AS total_reviews,
  floor(sum(CAST(round(avg_rating * 100) AS BIGINT) * review_count) / sum(review_count) / 100 * 10000 + 0.5) / 10000.0
    AS weighted_avg_rating FROM ({YEARLY}) GROUP BY review_year""")
def _(m):
    return A.yearly_trend(m.temporal_trends, LO, HI)


@entry("N11_A13_W9_yoy_growth", f"""SELECT source_category, review_year, review_count,
  floor((review_count / nullif(prev, 0) - 1) * 100 * 10000 + 0.5) / 10000.0 AS growth_pct FROM (
    SELECT *, lag(review_count) OVER (PARTITION BY source_category ORDER BY review_year) AS prev FROM (
      SELECT c.source_category, y.review_year, coalesce(t.review_count, 0) AS review_count
      FROM (SELECT DISTINCT source_category FROM ({YEARLY})) c,
        (SELECT unnest(range({LO}, {HI} + 1)) AS review_year) y
      LEFT JOIN ({YEARLY}) t ON t.source_category = c.source_category AND t.review_year = y.review_year))
  WHERE review_year > {LO}""")
def _(m):
    return A.yoy_growth(m.temporal_trends, LO, HI)


CAGR = f"""SELECT *, floor((pow(end_vol / start_vol, CAST(1 AS DOUBLE) / ({HI} - {LO})) - 1) * 100 * 10000 + 0.5)
    / 10000.0 AS cagr_pct FROM (
  SELECT source_category,
    CAST(coalesce(sum(review_count) FILTER (WHERE review_year = {LO}), 0) AS BIGINT) AS start_vol,
    CAST(coalesce(sum(review_count) FILTER (WHERE review_year = {HI}), 0) AS BIGINT) AS end_vol
  FROM temporal_trends GROUP BY source_category) WHERE start_vol > 0"""


@entry("N12_K4_cagr", both_ends(CAGR, "cagr_pct", 3, "source_category"))
def _(m):
    return A.cagr(m.temporal_trends, LO, HI, 3)


B0, B1 = roles.BASE_YEARS
NOW, THEN = f"review_year >= {roles.RECENT_YEAR}", f"review_year BETWEEN {B0} AND {B1}"
R100 = "CAST(round(avg_rating * 100) AS BIGINT)"


@entry("N13_period_shift", f"""SELECT source_category,
  floor((avg(review_count) FILTER (WHERE {NOW}) / nullif(avg(review_count) FILTER (WHERE {THEN}), 0) - 1)
    * 100 * 10 + 0.5) / 10.0 AS volume_change_pct,
  floor((avg({R100}) FILTER (WHERE {NOW}) - avg({R100}) FILTER (WHERE {THEN})) / 100 * 1000 + 0.5) / 1000.0
    AS rating_shift
  FROM temporal_trends GROUP BY source_category""")
def _(m):
    return A.period_shift(m.temporal_trends, roles.RECENT_YEAR, roles.BASE_YEARS)


CENTS = "CAST(sum(CAST(round(total_revenue * 100) AS BIGINT)) AS BIGINT)"


def totals(t: str, key: str) -> str:
    return (
        f"SELECT {key}, {CENTS} / 100.0 AS total_revenue, CAST(sum(product_count) AS BIGINT) AS total_products, "
        f"{CENTS} / 100.0 / nullif(sum(product_count), 0) AS rev_per_product FROM {t} GROUP BY {key}"
    )


@entry("N14_K2_tier_totals", f"""SELECT price_tier, cents / 100.0 AS total_revenue, total_products,
  cents / 100.0 / nullif(total_products, 0) AS rev_per_product,
  floor(cents * 100.0 / sum(cents) OVER () * 10 + 0.5) / 10.0 AS rev_pct
  FROM (SELECT price_tier, {CENTS} AS cents, CAST(sum(product_count) AS BIGINT) AS total_products
        FROM price_positioning GROUP BY price_tier)""")
def _(m):
    return A.tier_totals(m.price_positioning)


def dominant(t: str, tier: str) -> str:
    return (
        f"SELECT subcategory, {tier}, total_revenue FROM (SELECT *, row_number() OVER ("
        f"PARTITION BY subcategory ORDER BY total_revenue DESC NULLS LAST, {tier} DESC) AS nth FROM {t}) "
        "WHERE nth = 1"
    )


for _n, _t, _tier in [
    ("price", "price_positioning", "price_tier"), ("discount", "discount_effectiveness", "discount_tier"),
]:
    entry(f"N15_W7_dominant_{_n}_tier", dominant(_t, _tier))(
        lambda m, t=_t, tier=_tier: A.dominant(getattr(m, t), tier))
    entry(f"N15_A20_{_n}_tier_wins",
          f"SELECT {_tier}, count(*) AS categories_won FROM ({dominant(_t, _tier)}) GROUP BY {_tier}")(
        lambda m, t=_t, tier=_tier: A.tier_wins(getattr(m, t), tier))
    entry(f"N16_K5_W6_{_n}_tier_share", f"""
      SELECT subcategory, {_tier}, cents / 100.0 AS total_revenue,
        floor(cents / nullif(sum(cents) OVER (PARTITION BY subcategory), 0) * 100 * 10000 + 0.5) / 10000.0 AS rev_share
      FROM (SELECT subcategory, {_tier}, CAST(round(total_revenue * 100) AS BIGINT) AS cents FROM {_t})
      WHERE subcategory IN (SELECT subcategory FROM {_t} GROUP BY subcategory
        ORDER BY sum(CAST(round(total_revenue * 100) AS BIGINT)) DESC, subcategory LIMIT 15)""")(
        lambda m, t=_t, tier=_tier: A.tier_share(getattr(m, t), tier))


TIER_RATIO = """SELECT subcategory, hi / nullif(lo, 0) AS ratio FROM (SELECT subcategory,
  max(total_revenue / product_count) FILTER (WHERE price_tier = 'Luxury') AS hi,
  max(total_revenue / product_count) FILTER (WHERE price_tier = 'Budget') AS lo
  FROM price_positioning GROUP BY subcategory)"""


@entry("N17_K4_tier_ratio", f"""SELECT subcategory, floor(ratio * 10000 + 0.5) / 10000.0 AS ratio,
  floor(log2(ratio) * 10000 + 0.5) / 10000.0 AS log2_ratio
  FROM ({both_ends(TIER_RATIO, 'ratio', 5, 'subcategory')}) WHERE ratio > 0""")
def _(m):
    return A.tier_ratio(m.price_positioning, k=5)


@entry("N18_tier_rating", f"""SELECT price_tier,
  floor(sum({R100}) / count(avg_rating) / 100 * 10000 + 0.5) / 10000.0 AS avg_rating,
  CAST(sum(product_count) AS BIGINT) AS total_products FROM price_positioning GROUP BY price_tier""")
def _(m):
    return A.tier_rating(m.price_positioning)


@entry("N19_discount_curve", totals("discount_effectiveness", "discount_tier"))
def _(m):
    return A.discount_curve(m.discount_effectiveness)


@entry("N20_discounted_vs_full", totals(
    "(SELECT *, if(discount_tier = 'No Discount', 'Full Price', 'Discounted') AS label "
    "FROM discount_effectiveness)", "label"))
def _(m):
    return A.discounted_vs_full(m.discount_effectiveness)


@entry("N21_K5_sweet_spot", """SELECT subcategory, price_tier, total_revenue / product_count AS rev_per_product
  FROM price_positioning WHERE subcategory IN (SELECT subcategory FROM price_positioning GROUP BY subcategory
    ORDER BY sum(CAST(round(total_revenue * 100) AS BIGINT)) DESC, subcategory LIMIT 4)""")
def _(m):
    return A.sweet_spot(m.price_positioning)


@entry("N22_brand_totals", totals("brand_dynamics", "brand_status"))
def _(m):
    return A.brand_totals(m.brand_dynamics)


BRAND_RATIO = """SELECT subcategory,
  max(total_revenue / product_count) FILTER (WHERE brand_status = 'Branded')
  / nullif(max(total_revenue / product_count) FILTER (WHERE brand_status = 'Unbranded'), 0) AS brand_multiplier
  FROM brand_dynamics GROUP BY subcategory"""


@entry("N23_A13_brand_multiplier", f"""SELECT subcategory,
  floor(brand_multiplier * 10000 + 0.5) / 10000.0 AS brand_multiplier,
  floor(log2(brand_multiplier) * 10000 + 0.5) / 10000.0 AS log2_multiplier
  FROM ({both_ends(BRAND_RATIO, 'brand_multiplier', 15, 'subcategory')}) WHERE brand_multiplier > 0""")
def _(m):
    return A.brand_multiplier(m.brand_dynamics)


BRAND_SHARE = f"""SELECT *, {S.ratio('branded', 'branded + unbranded', 1000, 10)} AS branded_pct FROM (
  SELECT subcategory,
    coalesce(max(product_count) FILTER (WHERE brand_status = 'Branded'), 0) AS branded,
    coalesce(max(product_count) FILTER (WHERE brand_status = 'Unbranded'), 0) AS unbranded
  FROM brand_dynamics GROUP BY subcategory)"""


@entry("N23_brand_presence", both_ends(BRAND_SHARE, "branded_pct", 20, "subcategory"))
def _(m):
    return A.brand_presence(m.brand_dynamics)


@entry("N24_A14_element_multipliers", " UNION ALL ".join(
    f"SELECT '{name}' AS element, floor(median({a} / nullif({b}, 0)) * 10000 + 0.5) / 10000.0 AS median_multiplier "
    "FROM listing_quality" for name, (a, b) in A.LISTING_ELEMENTS.items()))
def _(m):
    return A.element_multipliers(m.listing_quality)


@entry("N25_completeness_leaders", top(
    "SELECT subcategory, avg_rev_high_completeness / nullif(avg_rev_low_completeness, 0) "
    "AS completeness_multiplier FROM listing_quality", "completeness_multiplier", 20, "subcategory"))
def _(m):
    return A.completeness_leaders(m.listing_quality)


@entry("N25_badge_leaders", top(
    "SELECT subcategory, bestseller_revenue_multiplier FROM bestseller_analysis",
    "bestseller_revenue_multiplier", 20, "subcategory"))
def _(m):
    return A.badge_leaders(m.bestseller_analysis)


@entry("N25_badge_rates", """SELECT
  floor(median(CAST(round(pct_bestsellers * 100) AS BIGINT)) / 100 * 10000 + 0.5) / 10000.0 AS median_badge_rate,
  count(*) FILTER (WHERE pct_bestsellers > 3) AS categories_above FROM bestseller_analysis""")
def _(m):
    return A.badge_rates(m.bestseller_analysis, 3)


DENSE = "(SELECT *, total_revenue / nullif(product_count, 0) AS rev_per_product FROM subcategory_landscape)"


@entry("N26_A16_coverage_correlations", " UNION ALL ".join(
    f"SELECT '{p}' AS element, floor(corr(pct_with_{p}, rev_per_product) * 1000000 + 0.5) / 1000000.0 AS corr FROM {DENSE}"
    for p in ("brand", "features", "description", "store")))
def _(m):
    return A.coverage_correlations(m.subcategory_landscape)


@entry("N26_A16_signal_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, floor(corr({a}, {b}) * 1000000 + 0.5) / 1000000.0 AS corr FROM {DENSE}"
    for a in A.SIGNALS for b in A.SIGNALS))
def _(m):
    return A.signal_correlations(m.subcategory_landscape)


@entry("N27_J9_badge_vs_activity", """SELECT b.subcategory, pct_bestsellers, l.pct_active
  FROM bestseller_analysis b LEFT JOIN subcategory_landscape l
  ON b.subcategory IS NOT DISTINCT FROM l.subcategory""")
def _(m):
    return A.badge_vs_activity(m.bestseller_analysis, m.subcategory_landscape)


@entry("N28_store_size_stats", f"""SELECT count(*) AS stores, {S.pct('listed_products = 1')} AS pct_single_product,
  max(listed_products) AS max_products,
  floor(median(listed_products) * 100 + 0.5) / 100.0 / 1.0 AS median_products,
  floor(quantile_cont(listed_products, 0.99) * 100 + 0.5) / 100.0 / 1.0 AS p99_products
  FROM store_performance""")
def _(m):
    return A.store_size_stats(m.store_performance)


def mean4(c: str, per: int = 100) -> str:
    return (
        f"floor(sum(CAST(round({c} * {per}) AS BIGINT)) / count({c}) / {per} * 10000 + 0.5) / 10000.0"
    )


AVG_LISTED = "floor(avg(listed_products) * 10000 + 0.5) / 10000.0"


@entry("N28_P20_store_size_tiers", f"""SELECT * EXCLUDE (cents), cents / 100.0 AS total_revenue,
  floor(store_count * 100.0 / sum(store_count) OVER () * 10000 + 0.5) / 10000.0 AS pct_stores,
  floor(cents * 100.0 / sum(cents) OVER () * 10000 + 0.5) / 10000.0 AS pct_revenue FROM (
  SELECT CASE WHEN listed_products > 100 THEN '100+ products' WHEN listed_products > 20 THEN '21-100 products'
      WHEN listed_products > 5 THEN '6-20 products' WHEN listed_products > 1 THEN '2-5 products'
      WHEN listed_products > 0 THEN '1 product' END AS size_tier,
    count(*) AS store_count, {CENTS} AS cents,
    {mean4('avg_revenue_per_product')} AS avg_rev_per_product, {AVG_LISTED} AS avg_products
  FROM store_performance GROUP BY 1)""")
def _(m):
    return A.store_size_tiers(m.store_performance)


@entry("N29_P16_store_type_stats", f"""SELECT *,
  floor(store_count * 100.0 / sum(store_count) OVER () * 10000 + 0.5) / 10000.0 AS pct_stores FROM (
  SELECT store_type, count(*) AS store_count, {mean4('avg_revenue_per_product')} AS avg_rev_per_product,
    {CENTS} / 100.0 AS total_revenue, {AVG_LISTED} AS avg_products, {mean4('avg_rating')} AS avg_rating
  FROM store_performance GROUP BY store_type)""")
def _(m):
    return A.store_type_stats(m.store_performance)


@entry("N29_diversification", f"""SELECT category_count, count(*) AS store_count,
  {mean4('avg_revenue_per_product')} AS avg_rev_per_product, {AVG_LISTED} AS avg_products
  FROM store_performance WHERE category_count <= 10 GROUP BY category_count""")
def _(m):
    return A.diversification(m.store_performance)


CURVE = """SELECT store, cents / 100.0 AS total,
  row_number() OVER falling AS rank, sum(cents) OVER falling / 100.0 AS cumulative,
  sum(cents) OVER falling / sum(cents) OVER () * 100 AS cum_pct_total,
  row_number() OVER falling / count(*) OVER () * 100 AS cum_pct_rows
  FROM (SELECT store, CAST(round(total_revenue * 100) AS BIGINT) AS cents FROM store_performance)
  WINDOW falling AS (ORDER BY cents DESC NULLS LAST, md5(store), store
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@entry("N30_W8_concentration", CURVE)
def _(m):
    return A.concentration(stored(m, "store_performance"))


@entry("N30_W8_concentration_summary", """SELECT count(*) AS rows_total,
  count(*) FILTER (WHERE running * 100 <= 50 * whole) AS rows_for_50pct,
  count(*) FILTER (WHERE running * 100 <= 80 * whole) AS rows_for_80pct,
  count(*) FILTER (WHERE running * 100 <= 90 * whole) AS rows_for_90pct,
  floor(sum(cents) FILTER (WHERE nth <= greatest(n // 100, 1)) / max(whole) * 100 * 10 + 0.5) / 10.0
    AS top_1pct_share
  FROM (SELECT cents, sum(cents) OVER falling AS running, sum(cents) OVER () AS whole,
      row_number() OVER falling AS nth, count(*) OVER () AS n
    FROM (SELECT store, CAST(round(total_revenue * 100) AS BIGINT) AS cents FROM store_performance)
    WINDOW falling AS (ORDER BY cents DESC, store ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")
def _(m):
    return A.concentration_summary(m.store_performance)


EARNING = "store_performance WHERE avg_rating > 0 AND avg_revenue_per_product > 0"


@entry("N31_P21_rating_vs_revenue", f"""SELECT rating_bin, count(*) AS store_count,
  {S.money('cents')} AS avg_rev, floor(median(cents) + 0.5) / 100.0 AS median_rev FROM (
  SELECT CAST(round(avg_revenue_per_product * 100) AS BIGINT) AS cents,
    CASE WHEN avg_rating <= 2 THEN '0-2' WHEN avg_rating <= 3 THEN '2-3' WHEN avg_rating <= 3.5 THEN '3-3.5'
      WHEN avg_rating <= 4 THEN '3.5-4' WHEN avg_rating <= 4.5 THEN '4-4.5'
      WHEN avg_rating <= 5.01 THEN '4.5-5' END AS rating_bin
  FROM {EARNING}) GROUP BY rating_bin""")
def _(m):
    return A.rating_vs_revenue(m.store_performance)


@entry("N31_A16_rating_revenue_corr", f"""SELECT
  floor(corr(avg_rating, avg_revenue_per_product) * 1000000 + 0.5) / 1000000.0 AS corr FROM {EARNING}""")
def _(m):
    return A.rating_revenue_corr(m.store_performance)


@entry("P27_trim_upper", """SELECT store, store_type, listed_products,
  CAST(round(avg_revenue_per_product * 100) AS BIGINT) AS cents FROM store_performance
  WHERE listed_products <= (SELECT quantile_cont(listed_products, 0.95) FROM store_performance)
    AND CAST(round(avg_revenue_per_product * 100) AS BIGINT)
      <= (SELECT quantile_cont(CAST(round(avg_revenue_per_product * 100) AS BIGINT), 0.95) FROM store_performance)
    AND avg_revenue_per_product > 0""")
def _(m):
    return A.trim_stores(m.store_performance, 0.95)


LIFT = " UNION ALL ".join(
    f"SELECT subcategory, '{n}' AS element, coalesce({a}, 0) AS with_part, coalesce({b}, 0) AS without_part, "
    f"CASE WHEN coalesce({b}, 0) > 0 THEN floor((coalesce({a}, 0) / {b} - 1) * 100 * 10000 + 0.5) / 10000.0 "
    "ELSE 0 END AS lift_pct FROM listing_quality"
    for n, (a, b) in list(A.LISTING_ELEMENTS.items())[:3]
)


@entry("N33_listing_lift", LIFT)
def _(m):
    return A.listing_lift(m.listing_quality)


ASIN = "102"


def _versus(label, own, avg):
    return (
        f"SELECT asin, '{label}' AS metric, coalesce({own}, 0) AS product, coalesce(l.{avg}, 0) AS category_avg, "
        f"CASE WHEN coalesce(l.{avg}, 0) > 0 THEN floor((coalesce({own}, 0) / l.{avg} - 1) * 100 * 10 + 0.5) / 10.0 "
        f"ELSE 0 END AS difference_pct FROM products p JOIN subcategory_landscape l "
        f"ON p.subcategory IS NOT DISTINCT FROM l.subcategory WHERE asin = '{ASIN}'"
    )


@entry("N34_product_vs_category", " UNION ALL ".join([
    _versus("Price", "price_cents / 100.0", "avg_price"),
    _versus("Rating", "rating_tenths / 10.0", "avg_rating"),
    _versus("Reviews", "CAST(p.review_count AS DOUBLE)", "avg_reviews"),
    _versus("Revenue/Product", "revenue_cents / 100.0", "avg_revenue_per_product"),
]))
def _(m):
    return A.product_vs_category(m.products, m.subcategory_landscape, ASIN)


for _id, _t, _c, _k, _asc, _key in [
    ("top_revenue", "subcategory_landscape", "total_revenue", 20, False, "subcategory"),
    ("least_active", "subcategory_landscape", "pct_active", 20, True, "subcategory"),
    ("largest_ecosystems", "main_category_landscape", "ecosystem_products", 25, False, "main_category"),
    ("top_stores", "store_performance", "total_revenue", 20, False, "store"),
]:
    entry(f"N39_K3_{_id}", top(f"SELECT * FROM {_t}", _c, _k, _key, asc=_asc))(
        lambda m, t=_t, c=_c, k=_k, asc=_asc, key=_key: gp.leaderboard(getattr(m, t), c, k, asc, [key]))


@entry("N39_K3_top_density", top(
    "SELECT *, total_revenue / nullif(product_count, 0) AS revenue_per_product FROM subcategory_landscape",
    "revenue_per_product", 20, "subcategory"))
def _(m):
    return gp.leaderboard(A.demand_density(m.subcategory_landscape), "revenue_per_product", 20, key=["subcategory"])


@entry("N39_K3_most_oversaturated", top(
    "SELECT *, product_count / nullif(pct_active, 0) AS competition_score FROM subcategory_landscape",
    "competition_score", 20, "subcategory"))
def _(m):
    return gp.leaderboard(A.competition(m.subcategory_landscape), "competition_score", 20, key=["subcategory"])


# ---- models -----------------------------------------------------------------------

SELLABLE = "products WHERE bought_last_month > 0 AND price_cents > 0 AND rating_tenths > 0"


def prank(c: str, name: str) -> str:
    return f"percent_rank() OVER (PARTITION BY subcategory ORDER BY {c} NULLS LAST) AS {name}"


def _features(m):
    return once(m, "cluster_features", lambda: clusters.checkpointed(
        clusters.cluster_features(stored(m, "products"))))


def _archetypes(m):
    return once(m, "archetypes", lambda: clusters.fit_archetypes(_features(m)))


def _assigned(m):
    return once(m, "assigned", lambda: clusters.checkpointed(clusters.assign_archetypes(_features(m), model=_archetypes(m))))


@entry("M1_W1_cluster_features", f"""SELECT asin, subcategory, price_cents, rating_tenths, review_count,
  bought_last_month, revenue_cents, title_length, rating_tenths / 10.0 AS rating,
  is_best_seller::INTEGER AS is_best_seller, {prank('price_cents', 'price_rank')},
  {prank('bought_last_month', 'sales_rank')}, {prank('review_count', 'reviews_rank')},
  {prank('title_length', 'title_length_rank')} FROM {SELLABLE}""")
def _(m):
    return clusters.cluster_features(stored(m, "products"))


@entry("M2_choose_k")
def _(m):
    return clusters.choose_k(_features(m))


@entry("M3_product_clusters")
def _(m):
    return m.product_clusters


@entry("M3_nearest_centre", f"SELECT count(*) AS listings, count(*) AS at_nearest FROM {SELLABLE}")
def _(m):
    return clusters.placement_check(_assigned(m), clusters.centre_table(_archetypes(m)))


@entry("M3_centres_at_rest", f"SELECT least(count(*), 5) AS archetypes, least(count(*), 5) AS at_rest FROM {SELLABLE}")
def _(m):
    return clusters.rest_check(_assigned(m), clusters.centre_table(_archetypes(m)))


@entry("M3_same_answer_in_other_partitions", f"""SELECT count(*) AS listings, count(*) AS same_cluster FROM {SELLABLE}""")
def _(m):
    """The model fitted once more, on the listings in other partitions and another order."""
    other = clusters.fit_archetypes(_features(m).repartition(7, "title_length_rank"))
    again = clusters.assign_archetypes(_features(m), model=other).select("asin", F.col("cluster").alias("again"))
    return _assigned(m).join(again, "asin").agg(
        F.count(F.lit(1)).alias("listings"), F.count_if(F.col("cluster") == F.col("again")).alias("same_cluster")
    )


@entry("M3_A17_archetype_profiles")
def _(m):
    return clusters.archetype_profiles(_assigned(m))


TRUST_SQL = """SELECT parent_asin, source_category, t.review_count, reviews_per_day,
  pct_verified / 100.0 AS verified_rate, pct_extreme_ratings / 100.0 AS extreme_ratio,
  pct_with_text / 100.0 AS text_rate, pct_very_short_text / 100.0 AS short_text_rate, reviews_per_reviewer,
  coalesce(pct_5star_unverified - pct_5star_verified, 0) AS unverified_5star_gap, pct_5star, pct_1star,
  coalesce(t.avg_text_length, 0) AS avg_text_length, s.reviews_per_month, pct_with_helpful_votes
  FROM product_review_trust t
  JOIN (SELECT parent_asin, source_category, reviews_per_month FROM product_review_summary) s
    USING (parent_asin, source_category) WHERE t.review_count >= 5"""


def _axes(source: str, features: list[str]) -> dict[str, str]:
    """SQL of the first two principal axes of scaled features: power iteration on their correlations, the second after taking
    the first out.  A column that does not vary has no correlations."""
    m = "[" + ", ".join("[" + ", ".join(f"coalesce(corr({f}, {g}), 0)" for g in features) + "]" for f in features) + "]"
    d = len(features)
    step = "[list_dot_product(r, v) FOR r IN m]"
    unit = "[x / sqrt(list_dot_product(w, w)) FOR x IN w]"
    start = "[" + ", ".join(f"CAST({1 + i / 7} AS DOUBLE)" for i in range(d)) + "]"

    def power(name: str, matrix: str) -> dict[str, str]:
        return {
            f"{name}_steps": f"""SELECT m, i, v FROM (WITH RECURSIVE walk AS (
                SELECT {matrix} AS m, 0 AS i, {start} AS v
                UNION ALL SELECT m, i + 1, {unit} FROM (SELECT m, i, {step} AS w FROM walk) WHERE i < 2000) SELECT * FROM walk)""",
            f"{name}_axis": f"""SELECT v AS raw, list_dot_product(v, {step}) AS spread,
                CASE WHEN v[list_position([round(abs(x), 9) FOR x IN v], list_max([round(abs(x), 9) FOR x IN v]))] >= 0 THEN v ELSE [-x FOR x IN v] END AS v
                FROM {name}_steps WHERE i = 2000""",
        }

    return {
        "correlations": f"SELECT {m} AS m FROM ({source})",
        **power("first", "(SELECT m FROM correlations)"),
        **power("second", f"""(SELECT [[m[i][j] - spread * raw[i] * raw[j] FOR j IN generate_series(1, {d})]
            FOR i IN generate_series(1, {d})] FROM correlations, first_axis)"""),
    }


def _projection_sql(source: str, keys: str, features: list[str]) -> str:
    scaled = ", ".join(f"coalesce(({f} - avg({f}) OVER ()) / nullif(stddev_samp({f}) OVER (), 0), 0)" for f in features)
    rounded = "floor(list_dot_product(z, (SELECT v FROM {}_axis)) * 1e4 + 0.5) / 1e4 AS {}"
    return f"""SELECT {keys}, {rounded.format("first", "pc1")}, {rounded.format("second", "pc2")}
      FROM (SELECT {keys}, [{scaled}] AS z FROM ({source}))"""


def _loadings_sql(features: list[str]) -> str:
    # The variance of all components together is the number of columns that vary.
    total = "(SELECT list_sum([m[i][i] FOR i IN generate_series(1, len(m))]) FROM correlations)"
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS component, '{f}' AS feature, floor(v[{i + 1}] * 1000 + 0.5) / 1000.0 AS loading,
        floor(spread / {total} * 1e4 + 0.5) / 1e4 AS explained_variance FROM {axis}_axis"""
        for name, axis in (("PC1", "first"), ("PC2", "second")) for i, f in enumerate(features))


def _four(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: E.half_up(c, 10**4) for c in columns})


CLUSTER_SQL = f"""SELECT asin, rating_tenths / 10.0 AS rating, is_best_seller::INTEGER AS is_best_seller, {prank('price_cents', 'price_rank')},
  {prank('bought_last_month', 'sales_rank')}, {prank('review_count', 'reviews_rank')},
  {prank('title_length', 'title_length_rank')} FROM {SELLABLE}"""


@entry("M4_projection", _projection_sql("cluster_listing", "asin", clusters.FEATURES), cluster_listing=CLUSTER_SQL,
       **_axes("SELECT * FROM cluster_listing", clusters.FEATURES))
def _(m):
    df = _features(m)
    return _four(clusters.project(df, clusters.FEATURES).select("asin", "pc1", "pc2"), "pc1", "pc2")


@entry("M4_loadings", _loadings_sql(clusters.FEATURES), cluster_listing=CLUSTER_SQL, **_axes("SELECT * FROM cluster_listing", clusters.FEATURES))
def _(m):
    return _four(clusters.loadings(_features(m), clusters.FEATURES), "explained_variance")


SUCCESS_SQL = f"""SELECT asin, subcategory, revenue_cents,
  CAST(revenue_quartile AS INTEGER) AS revenue_quartile, (revenue_quartile = 4)::INTEGER AS is_success,
  price_cents / 100.0 AS price, rating_tenths / 10.0 AS rating, CAST(review_count AS DOUBLE) AS review_count,
  CAST(title_length AS DOUBLE) AS title_length, CAST(is_best_seller AS DOUBLE) AS is_best_seller,
  CAST(has_brand AS DOUBLE) AS has_brand, CAST(has_features AS DOUBLE) AS has_features,
  CAST(has_description AS DOUBLE) AS has_description, CAST(has_store AS DOUBLE) AS has_store,
  coalesce(discount_tenths / 10.0, 0) AS discount_pct, CAST(is_matched AS DOUBLE) AS is_matched,
  price_rank, reviews_rank, title_length_rank
  FROM (SELECT *, {prank('price_cents', 'price_rank')}, {prank('review_count', 'reviews_rank')},
      {prank('title_length', 'title_length_rank')},
      ntile(4) OVER (PARTITION BY subcategory ORDER BY revenue_cents, md5(asin), asin) AS revenue_quartile
    FROM {SELLABLE})"""


@entry("M5_W1_W2_success_features", SUCCESS_SQL)
def _(m):
    return success.success_features(stored(m, "products"))


def _trust_signals(m):
    return once(m, "trust_signals", lambda: clusters.checkpointed(trust_signals(m)))


_TRUST_AXES = _axes("SELECT * FROM trust_signals", A.TRUST_FEATURES)


@entry("M4_trust_projection", _projection_sql("trust_signals", "parent_asin, source_category", A.TRUST_FEATURES),
       trust_signals=TRUST_SQL, **_TRUST_AXES)
def _(m):
    df = clusters.project(_trust_signals(m), A.TRUST_FEATURES)
    return _four(df.select("parent_asin", "source_category", "pc1", "pc2"), "pc1", "pc2")


@entry("M4_trust_loadings", _loadings_sql(A.TRUST_FEATURES), trust_signals=TRUST_SQL, **_TRUST_AXES)
def _(m):
    return _four(clusters.loadings(_trust_signals(m), A.TRUST_FEATURES), "explained_variance")


def _success(m):
    """Split and model shared by the success queries."""
    def make():
        features = clusters.checkpointed(success.success_features(stored(m, "products")))
        split = clusters.checkpointed(success.stratified_split(features))
        return split, success.train_success(split)

    return once(m, "success", make)


def _held_out(m):
    split, model = _success(m)
    return success.predict(model, split.where("fold = 'test'")), model


@entry("M5_success_predictions")
def _(m):
    predicted, _ = _held_out(m)
    return predicted.select("asin", "subcategory", "is_success", "predicted", "score")


@entry("M5e_success_evaluation")
def _(m):
    return success.evaluate_success(_held_out(m)[0])


@entry("M5e_confusion_matrix")
def _(m):
    return success.confusion_matrix(_held_out(m)[0])


@entry("M5e_roc_curve")
def _(m):
    return success.roc_curve(_held_out(m)[0])


@entry("M5e_feature_importance")
def _(m):
    return success.feature_importance(m.products.sparkSession, _success(m)[1])


def _explained(m):
    def make():
        split, model = _success(m)
        leaves = once(m, "leaves", lambda: attributions.tree_leaves(model, m.products.sparkSession))
        return clusters.checkpointed(attributions.explain(model, split.where("fold = 'test'"), leaves))

    return once(m, "explained", make)


@entry("M6_attributions")
def _(m):
    return _explained(m)


@entry("M6_waterfall")
def _(m):
    return attributions.waterfall(_explained(m))


@entry("M7_shap_summary")
def _(m):
    return attributions.shap_summary(_explained(m))


@entry("M8_J7_trust_features", TRUST_SQL)
def _(m):
    return trust_signals(m)


@entry("M9_product_trust_scores")
def _(m):
    return with_facts(m).product_trust_scores


@entry("M9_trust_cutoff")
def _(m):
    return anomalies.trust_cutoff(trust_scores(m))


@entry("M11_compare_groups")
def _(m):
    return serving.compare_groups(trust_scores(m))


@entry("N35_anomaly_by_category")
def _(m):
    return A.anomaly_by_category(trust_scores(m))


@entry("N36_suspicious_deviation")
def _(m):
    return A.suspicious_deviation(trust_scores(m), A.TRUST_FEATURES)


@entry("N37_P22_trust_tiers")
def _(m):
    return A.trust_tiers(trust_scores(m))


def _quintile(c: str) -> str:
    edges = ", ".join(f"quantile_cont({c}, {i / 5})" for i in range(6))
    return f"""SELECT bucket, edges[bucket] AS bucket_low, edges[bucket + 1] AS bucket_high,
      count(*) AS products, floor(sum(is_success) / count(*) * 10000 + 0.5) / 10000.0 AS success_rate
    FROM (SELECT is_success, edges,
        CAST(greatest(len(list_filter(edges, lambda e: e < v)), 1) AS INTEGER) AS bucket
      FROM (SELECT {c} AS v, (revenue_quartile = 4)::INTEGER AS is_success,
          ntile_edges.edges AS edges
        FROM (SELECT *, ntile(4) OVER (PARTITION BY subcategory ORDER BY revenue_cents, md5(asin), asin)
                AS revenue_quartile FROM {SELLABLE}),
          (SELECT list_sort(list_distinct([{edges}])) AS edges FROM {SELLABLE}) ntile_edges))
    GROUP BY bucket, edges"""


@entry("N38_W11_success_by_quintile", _quintile("review_count"))
def _(m):
    df = _success(m)[0].withColumn("review_count", F.col("review_count").cast("long"))
    return A.success_by_quintile(df, "review_count")


@entry("N40_A18_archetype_mix")
def _(m):
    return clusters.archetype_mix(_assigned(m))


@entry("N41_cluster_radar")
def _(m):
    return clusters.cluster_radar(_assigned(m))


@entry("M10_save_and_load_model")
def _(m):
    """Fit, save, load, and apply the loaded pipeline."""
    from pyspark.ml import PipelineModel

    features = _features(m)
    path = scratch_path(features.sparkSession, "archetypes")
    models.save(clusters.fit_archetypes(features), path, {"features": clusters.FEATURES, "k": 5})
    model, info = models.load(features.sparkSession, path)
    assert isinstance(model, PipelineModel) and info["k"] == 5
    return clusters.assign_archetypes(features, model=model).select("asin", "cluster", "cluster_name")


# ---- derived columns ------------------------------------------------------------------

@entry("P1_P6_flags_metadata", """SELECT parent_asin, (price IS NULL OR price IN ('', '—')) AS flag_no_price,
  (store IS NULL OR store = '') AS flag_no_store, (details_brand IS NULL OR details_brand = '') AS flag_no_brand,
  (title IS NULL OR title = '') AS flag_no_title, coalesce(rating_number = 0, FALSE) AS flag_no_ratings FROM metadata""")
def _(m):
    return m.metadata.select("parent_asin", *[c for c in m.metadata.columns if c.startswith("flag_")])


@entry("P2_flags_categories", """SELECT id, category_name,
  (category_name IS NULL OR trim(category_name) = '')::INTEGER AS flag_missing_name,
  length(trim(category_name)) AS name_length FROM categories""")
def _(m):
    return m.categories


@entry("P3_P4_flags_reviews", """SELECT parent_asin, user_id, timestamp, text IS NOT NULL AND text <> '' AS has_text,
  title IS NOT NULL AND title <> '' AS has_title, helpful_vote > 0 AS has_helpful_votes,
  image_count, length(text) AS text_length FROM reviews""")
def _(m):
    plain = m.raw_reviews.drop("has_text", "has_title", "has_helpful_votes", "text_length")
    return C.flag_reviews(plain).select(
        "parent_asin", "user_id", "timestamp", "has_text", "has_title", "has_helpful_votes",
        "image_count", "text_length",
    )


@entry("P5_parse_price", """SELECT parent_asin, price,
  CAST(round(try_cast(replace(replace(nullif(price, '—'), '$', ''), ',', '') AS DOUBLE) * 100) AS BIGINT) / 100.0
    AS amount FROM metadata""")
def _(m):
    return m.metadata.select("parent_asin", "price", E.units(C.parse_price("price")).alias("amount"))


@entry("P7_P8_P9_P10_P12_P19_listing_columns", """SELECT asin,
  CASE WHEN price_cents > 0 AND list_cents > price_cents
    THEN floor(1000 * (list_cents - price_cents) / list_cents + 0.5) / 10.0 END AS discount_pct,
  price_cents * bought_last_month / 100.0 AS estimated_revenue,
  CASE WHEN price_cents < 1000 THEN 'Budget' WHEN price_cents < 2500 THEN 'Low'
    WHEN price_cents < 5000 THEN 'Mid' WHEN price_cents < 10000 THEN 'Premium'
    WHEN price_cents >= 10000 THEN 'Luxury' ELSE 'Unknown' END AS price_tier,
  CASE WHEN price_cents > 0 AND list_cents > price_cents THEN
      CASE WHEN floor(1000 * (list_cents - price_cents) / list_cents + 0.5) >= 500 THEN 'Deep (50%+)'
        WHEN floor(1000 * (list_cents - price_cents) / list_cents + 0.5) >= 200 THEN 'Medium (20-49%)'
        WHEN floor(1000 * (list_cents - price_cents) / list_cents + 0.5) > 0 THEN 'Light (1-19%)'
        ELSE 'No Discount' END
    ELSE 'No Discount' END AS discount_tier,
  CASE WHEN bought_last_month < 1 THEN '1. Zero sales' WHEN bought_last_month < 50 THEN '2. 1-49'
    WHEN bought_last_month < 500 THEN '3. 50-499' WHEN bought_last_month < 5000 THEN '4. 500-4999'
    ELSE '5. 5000+' END AS sales_tier,
  length(title) AS title_length FROM listings""")
def _(m):
    tenths = C.discount_tenths("price_cents", "list_cents")
    return m.listings.select(
        "asin", E.units(tenths, 10).alias("discount_pct"),
        E.units(C.estimated_revenue("price_cents", "bought_last_month")).alias("estimated_revenue"),
        C.price_tier("price_cents").alias("price_tier"), C.discount_tier(tenths).alias("discount_tier"),
        C.sales_tier("bought_last_month").alias("sales_tier"), F.length("title").cast("long").alias("title_length"),
    )


@entry("P11_P17_listing_parts", f"""SELECT parent_asin, {S.FILLED.format('features')}::INTEGER AS has_features,
  {S.FILLED.format('description')}::INTEGER AS has_description, (store IS NOT NULL)::INTEGER AS has_store,
  (details_brand IS NOT NULL)::INTEGER AS has_brand,
  if(details_brand IS NOT NULL, 'Branded', 'Unbranded') AS brand_status FROM metadata""")
def _(m):
    return C.listing_parts(m.metadata.withColumnRenamed("details_brand", "brand")).select(
        "parent_asin", "has_features", "has_description", "has_store", "has_brand",
        C.brand_status("has_brand").alias("brand_status"),
    )


@entry("P13_drop_without_main_category", """SELECT count(*) AS kept, count(DISTINCT parent_asin) AS products
  FROM metadata WHERE main_category IS NOT NULL""")
def _(m):
    return m.products_full.agg(F.count(F.lit(1)).alias("kept"), F.count_distinct("parent_asin").alias("products"))


@entry("P14_P25_review_dates", """SELECT review_date, review_year, review_month,
  make_date(review_year, review_month, 1) AS month_start, count(*) AS n FROM reviews GROUP BY ALL""")
def _(m):
    start = C.month_start(F.col("review_year").cast("int"), F.col("review_month").cast("int"))
    return m.reviews.groupBy("review_date", "review_year", "review_month", start.alias("month_start")).agg(
        F.count(F.lit(1)).alias("n")
    )


@entry("P15_sentiment", """SELECT source_category, sentiment, count(*) AS n FROM (SELECT source_category,
  CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative' ELSE 'neutral' END AS sentiment FROM reviews)
  GROUP BY ALL""")
def _(m):
    return m.reviews.groupBy("source_category", C.sentiment().alias("sentiment")).agg(F.count(F.lit(1)).alias("n"))


@entry("P16_store_type", """SELECT store_type, category_count, count(*) AS stores FROM stores GROUP BY ALL""")
def _(m):
    return m.stores.groupBy("store_type", "category_count").agg(F.count(F.lit(1)).alias("stores"))


@entry("P18_title_bands", """SELECT count(*) FILTER (WHERE title_length < 50) AS short_title,
  count(*) FILTER (WHERE title_length BETWEEN 50 AND 100) AS medium_title,
  count(*) FILTER (WHERE title_length BETWEEN 100 AND 150) AS long_title,
  count(*) FILTER (WHERE title_length > 150) AS very_long_title,
  count(*) FILTER (WHERE title_length = 100) AS in_two_bands FROM products""")
def _(m):
    n = F.col("title_length")
    return m.products.agg(
        *[F.count_if(band(n)).alias(name) for name, band in C.TITLE_BANDS.items()],
        F.count_if(n == 100).alias("in_two_bands"),
    )


@entry("P24_casts_and_defaults", """SELECT asin, is_best_seller::INTEGER AS badge, coalesce(has_brand, 0) AS has_brand,
  coalesce(discount_tenths, 0) / 10.0 AS discount_pct FROM products""")
def _(m):
    return m.products.select(
        "asin", C.as_int(F.col("is_best_seller")).alias("badge"), F.coalesce("has_brand", F.lit(0)).alias("has_brand"),
        E.units(F.coalesce("discount_tenths", F.lit(0)), 10).alias("discount_pct"),
    )


@entry("P26_A11_filters", """SELECT source_category, review_year, sum(review_count)::BIGINT AS reviews
  FROM temporal_trends WHERE source_category IN ('PROMO', 'MISC') AND review_year BETWEEN 1998 AND 2000
  GROUP BY ALL HAVING sum(review_count) >= 100""")
def _(m):
    kept = m.temporal_trends.where(
        F.col("source_category").isin("PROMO", "MISC") & F.col("review_year").between(1998, 2000)
    )
    per = kept.groupBy("source_category", "review_year").agg(F.sum("review_count").alias("reviews"))
    return rel.having(per, F.col("reviews") >= 100)


# ---- joins ------------------------------------------------------------------------------

@entry("J1_attach_category", """SELECT asin, category_id, category_name AS subcategory
  FROM listings LEFT JOIN categories ON category_id = id""")
def _(m):
    return silver.attach_category(m.listings, m.categories).select("asin", "category_id", "subcategory")


@entry("J2_enrich", """SELECT asin, main_category, store, is_matched FROM products""")
def _(m):
    return m.products.select("asin", "main_category", "store", "is_matched")


@entry("J2_enrich_repeated_metadata", "SELECT asin, main_category, store, revenue_cents FROM products")
def _(m):
    """Every metadata row twice: no listing may be multiplied."""
    return silver.products(m.listings, m.categories, rel.concat(m.metadata, m.metadata)).select(
        "asin", "main_category", "store", "revenue_cents"
    )


@entry("J2_enrich_deduped", """SELECT asin, main_category, store, is_matched FROM products""")
def _(m):
    return silver.products(m.listings, m.categories, m.metadata, dedupe=True, dedupe_metadata=True).select(
        "asin", "main_category", "store", "is_matched"
    )


@entry("J3_join_ecosystem", """SELECT main_category, c.product_count, r.revenue
  FROM category_profile c LEFT JOIN (SELECT main_category, sum(revenue_cents) / 100.0 AS revenue
    FROM products WHERE main_category IS NOT NULL GROUP BY main_category) r USING (main_category)""")
def _(m):
    revenue = m.products.where("main_category is not null").groupBy("main_category").agg(
        E.total_money("revenue_cents").alias("revenue")
    )
    return gp.join_ecosystem(m.category_profile.select("main_category", "product_count"), revenue)


@entry("J4_join_store", """SELECT store, product_count, n AS listed_products FROM stores
  JOIN (SELECT store, count(*) AS n FROM products WHERE store IS NOT NULL GROUP BY store) USING (store)""")
def _(m):
    sold = m.products.where("store is not null").groupBy("store").agg(F.count(F.lit(1)).alias("listed_products"))
    return gp.join_store(m.stores.select("store", "product_count"), sold)


@entry("J5_join_review_summary", """SELECT asin, source_category, s.avg_rating AS review_rating
  FROM products LEFT JOIN (SELECT parent_asin, source_category, avg_rating FROM product_review_summary) s
  ON parent_asin = asin""")
def _(m):
    return gp.join_review_summary(m.products, m.product_review_summary).select(
        "asin", "source_category", "review_rating"
    )


@entry("J6_only_known", """SELECT parent_asin, count(*) AS reviews FROM reviews
  WHERE parent_asin IN (SELECT asin FROM listings) GROUP BY parent_asin""")
def _(m):
    return rel.only_known(m.reviews, m.listings, "parent_asin").groupBy("parent_asin").agg(
        F.count(F.lit(1)).alias("reviews")
    )


@entry("J7_join_trust", """SELECT parent_asin, source_category, t.review_count, t.pct_verified,
  s.review_span_days, s.reviews_per_month, s.pct_negative FROM product_review_trust t
  JOIN product_review_summary s USING (parent_asin, source_category) WHERE t.review_count >= 5""")
def _(m):
    return gr.join_trust(m.product_review_trust, m.product_review_summary).select(
        "parent_asin", "source_category", "review_count", "pct_verified", "review_span_days",
        "reviews_per_month", "pct_negative",
    )


@entry("J10_explode_tokens", """SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split(regexp_replace(lower(title), '[^a-z0-9 ]', ' ', 'g'), ' ')) AS word FROM listings)
  WHERE word <> '' GROUP BY word""")
def _(m):
    return rel.explode_tokens(m.listings.select("title"), "title").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@entry("J11_with_scalars", """SELECT asin, price_cents / 100.0 AS price,
  (SELECT max(price_cents) FROM listings) / 100.0 AS highest,
  floor(price_cents * 100 / (SELECT max(price_cents) FROM listings) * 10 + 0.5) / 10.0 AS pct_of_highest FROM listings""")
def _(m):
    df = rel.with_scalars(m.listings.select("asin", "price_cents"), top=F.max("price_cents"))
    return df.select(
        "asin", E.units("price_cents").alias("price"), E.units("top").alias("highest"),
        E.half_up(F.try_divide((F.col("price_cents") * 100).cast("double"), F.col("top")), 10).alias("pct_of_highest"),
    )


# ---- aggregates ---------------------------------------------------------------------------

@entry("A1_A2_A6_A7_A8_A9_primitives", f"""SELECT subcategory, count(*) AS n, {S.big('sum(bought_last_month)')} AS units,
  min(price_cents) / 100.0 AS low, max(price_cents) / 100.0 AS high, {S.money('price_cents')} AS avg_price,
  count(DISTINCT store) AS stores, count(DISTINCT brand) AS brands,
  {S.big("coalesce(sum(revenue_cents) FILTER (WHERE is_best_seller), 0)")} AS badge_cents,
  {S.money('revenue_cents', 'is_best_seller')} AS badge_avg, count(*) FILTER (WHERE is_best_seller) AS badges,
  {S.pct('has_store = 1')} AS pct_store, {S.half_up('sum(bought_last_month) / nullif(sum(review_count), 0)', 1000)} AS sold_per_review,
  {S.ratio('count(*)', 'greatest(count(*) FILTER (WHERE is_best_seller), 1)', 100, 100)} AS per_badge
  FROM products GROUP BY subcategory""")
def _(m):
    badge = F.col("is_best_seller")
    return m.products.groupBy("subcategory").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bought_last_month").alias("units"),
        E.units(F.min("price_cents")).alias("low"), E.units(F.max("price_cents")).alias("high"),
        E.money_mean("price_cents").alias("avg_price"),
        rel.count_distinct("store").alias("stores"), rel.count_distinct("brand").alias("brands"),
        F.coalesce(E.sum_if(badge, "revenue_cents"), F.lit(0)).alias("badge_cents"),
        E.avg_if(badge, "revenue_cents", 1, 100).alias("badge_avg"), E.count_if(badge).alias("badges"),
        E.pct(F.col("has_store") == 1).alias("pct_store"),
        E.safe_ratio(F.sum("bought_last_month"), F.sum("review_count"), 1000).alias("sold_per_review"),
        E.floor_ratio(F.count(F.lit(1)), F.count_if(badge)).alias("per_badge"),
    )


@entry("A2_approx_count_distinct", """SELECT source_category, count(DISTINCT user_id) AS users, TRUE AS within_bound
  FROM reviews GROUP BY source_category""")
def _(m):
    """Exact counts, and whether the approximate ones are within three of their standard errors (5 %)."""
    users = rel.count_distinct("user_id"), rel.count_distinct("user_id", approx=True)
    per = m.reviews.groupBy("source_category").agg(users[0].alias("users"), users[1].alias("about"))
    return per.select("source_category", "users", (F.abs(F.col("about") - F.col("users")) <= F.col("users") * 0.15 + 1).alias("within_bound"))


def _user_sketches(m):
    """Distinct users per product and category, as a pipeline would store them."""
    return once(m, "user_sketches", lambda: clusters.checkpointed(sketches.distinct_sketches(m.reviews, gr.PRODUCT, "user_id")))


@entry("A2_sketched_users_per_category", """SELECT source_category, count(DISTINCT user_id) AS users, TRUE AS within_bound
  FROM reviews GROUP BY source_category""")
def _(m):
    """Estimates from the sketches of the categories' products, against exact counts."""
    merged = sketches.merge_distinct(_user_sketches(m), ["source_category"])
    return sketches.distinct_checked(m.reviews, ["source_category"], "user_id", merged).select(
        "source_category", F.col("exact").alias("users"), F.col("within").alias("within_bound")
    )


@entry("A2_union_of_sketches", """SELECT count(DISTINCT user_id) AS users, TRUE AS within_bound, TRUE AS union_as_whole FROM reviews""")
def _(m):
    """The union over products and categories says what one sketch over all reviews says."""
    whole = sketches.distinct_sketches(m.reviews, [], "user_id").select(sketches.sketch_distinct("sketch").alias("whole"))
    union = sketches.merge_distinct(_user_sketches(m), []).select(sketches.sketch_distinct("sketch").alias("union"))
    users = m.reviews.agg(F.count_distinct("user_id").alias("users"))
    return users.select(
        "users", (F.abs(union.scalar() - F.col("users")) <= F.col("users") * sketches.DISTINCT_ERROR + 1).alias("within_bound"),
        (union.scalar() == whole.scalar()).alias("union_as_whole"),
    )


@entry("A3_A4_quantiles", """SELECT subcategory, price_tier, floor(median(price_cents) + 0.5) / 100.0 AS mid,
  floor(quantile_cont(revenue_cents, 0.9) + 0.5) / 100.0 AS p90 FROM products GROUP BY ALL""")
def _(m):
    keys = ["subcategory", "price_tier"]
    return ranks.with_quantiles(m.products.select(*keys).distinct(), m.products, keys, {
        "mid": ("price_cents", 0.5, 1, 100), "p90": ("revenue_cents", 0.9, 1, 100),
    })


@entry("A5_approx_quantile", """SELECT parent_asin, source_category, quantile_disc(rating, 0.5) AS median_rating
  FROM listed_reviews GROUP BY ALL""")
def _(m):
    listed = rel.only_known(m.reviews, m.listings, "parent_asin")
    return listed.groupBy(*gr.PRODUCT).agg(rel.approx_quantile("rating", 0.5).alias("median_rating"))


@entry("A5_G16_sketch_median", "SELECT parent_asin, source_category, median_rating FROM product_review_summary")
def _(m):
    """Medians from sketches; products have few reviews, so the sketches still hold them all."""
    summary = gr.product_review_summary(m.reviews, m.listings, approx_median=True)
    return summary.select("parent_asin", "source_category", "median_rating")


def _lengths(m):
    """The reviews' text lengths by product, written once for the sketches and for the ranks they are checked by."""
    return once(m, "lengths", lambda: tables.materialize(
        m.reviews.select(*gr.PRODUCT, "text_length"), scratch_path(m.raw_reviews.sparkSession, "lengths")))


def _length_sketches(m):
    return once(m, "length_sketches", lambda: clusters.checkpointed(sketches.quantile_sketches(_lengths(m), gr.PRODUCT, "text_length")))


for _q in (0.1, 0.5, 0.9):
    @entry(f"A5_merged_sketch_p{int(100 * _q)}", """SELECT source_category, count(text_length) AS texts, TRUE AS within_bound
      FROM reviews GROUP BY source_category""")
    def _(m, q=_q):
        """Quantiles per category from the sketches of its products, each within the bound of its rank."""
        keys = ["source_category"]
        merged = sketches.merge_quantiles(_length_sketches(m), keys).select(
            *keys, F.kll_sketch_get_n_double("sketch").alias("texts"), sketches.sketch_quantile("sketch", q).alias("estimate"))
        checked = sketches.rank_checked(_lengths(m), keys, "text_length", q, merged.drop("texts"))
        return merged.select(*keys, "texts").join(checked, keys).select(*keys, "texts", F.col("within").alias("within_bound"))


@entry("A10_group_by_derived", """SELECT if(has_brand = 1, 'Branded', 'Unbranded') AS brand_status,
  count(*) AS n FROM products GROUP BY 1""")
def _(m):
    return m.products.groupBy(C.brand_status("has_brand").alias("brand_status")).agg(F.count(F.lit(1)).alias("n"))


@entry("A14_unpivot", " UNION ALL ".join(
    f"SELECT subcategory, '{c}' AS metric, {c} AS value FROM subcategory_landscape"
    for c in ("pct_with_brand", "pct_with_features", "pct_with_store")))
def _(m):
    return rel.unpivot(
        m.subcategory_landscape, ["subcategory"], ["pct_with_brand", "pct_with_features", "pct_with_store"]
    )


@entry("A17_group_profile", """SELECT price_tier, """ + ", ".join(
    f"floor(sum({c}) / count({c}) * 100 + 0.5) / 100.0 AS {c}_mean, "
    f"floor(median({c}) * 100 + 0.5) / 100.0 / 1.0 AS {c}_median"
    for c in ("review_count", "bought_last_month")) + " FROM products GROUP BY price_tier")
def _(m):
    return rel.group_profile(m.products, "price_tier", ["review_count", "bought_last_month"])


@entry("A18_crosstab_pct", """SELECT subcategory, price_tier, n,
  floor(n * 100.0 / sum(n) OVER (PARTITION BY subcategory) * 10 + 0.5) / 10.0 AS pct
  FROM (SELECT subcategory, price_tier, count(*) AS n FROM products GROUP BY ALL)""")
def _(m):
    return rel.crosstab_pct(m.products, "subcategory", "price_tier")


@entry("A19_distinct_values", "SELECT DISTINCT source_category FROM temporal_trends")
def _(m):
    return rel.distinct_values(m.temporal_trends, "source_category")


@entry("A20_value_counts", "SELECT price_tier, count(*) AS count FROM products GROUP BY price_tier")
def _(m):
    return rel.value_counts(m.products, "price_tier")


@entry("A21_describe", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count({c}) AS DOUBLE) AS non_null, "
    f"CAST(count(*) - count({c}) AS DOUBLE) AS nulls, floor(avg({c}) * 10000 + 0.5) / 10000.0 AS mean, "
    f"floor(stddev_samp({c}) * 10000 + 0.5) / 10000.0 AS std, CAST(min({c}) AS DOUBLE) AS min, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM products"
    for c in ("price_cents", "review_count", "title_length")))
def _(m):
    return rel.describe(m.products, ["price_cents", "review_count", "title_length"])


@entry("A21_histogram", """SELECT bin, count(*) AS n, lo + (hi - lo) / 20 * bin AS low FROM (
  SELECT lo, hi, CAST(least(floor((title_length - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin
  FROM products, (SELECT min(title_length) AS lo, max(title_length) AS hi FROM products))
  GROUP BY bin, lo, hi""")
def _(m):
    return rel.histogram(m.products, "title_length", 20)


# ---- windows ------------------------------------------------------------------------------

@entry("W1_percent_rank", f"""SELECT asin, subcategory, {prank('price_cents', 'price_rank')},
  {prank('title_length', 'title_rank')} FROM products""")
def _(m):
    ranked = ranks.percent_rank_in(stored(m, "products"), ["subcategory"], {"price_rank": "price_cents", "title_rank": "title_length"})
    return ranked.select("asin", "subcategory", "price_rank", "title_rank")


@entry("W2_ntile", """SELECT asin, subcategory, CAST(ntile(4) OVER (PARTITION BY subcategory
  ORDER BY revenue_cents NULLS LAST, md5(asin), asin) AS INTEGER) AS quartile FROM products""")
def _(m):
    return ranks.ntile_in(m.products, ["subcategory"], "revenue_cents", 4, "asin", "quartile").select(
        "asin", "subcategory", "quartile"
    )


@entry("W4_share_of_group", """SELECT subcategory, price_tier, n,
  n / sum(n) OVER (PARTITION BY subcategory) * 100 AS share_pct
  FROM (SELECT subcategory, price_tier, count(*) AS n FROM products GROUP BY ALL)""")
def _(m):
    per = m.products.groupBy("subcategory", "price_tier").agg(F.count(F.lit(1)).alias("n"))
    return ranks.share_of_group(per, ["subcategory"], "n")


_POS = {
    "price_pctile": "price_cents", "rating_pctile": "rating_tenths", "reviews_pctile": "review_count",
    "sales_pctile": "bought_last_month", "revenue_pctile": "revenue_cents",
}


@entry("W10_Q7_health_position", "SELECT * FROM (SELECT asin, subcategory, "
       + ", ".join(prank(c, n) for n, c in _POS.items())
       + " FROM products) WHERE asin IN ('7', '102', '1999')")
def _(m):
    return serving.health_position(m, ["7", "102", "1999"])


@entry("W11_quantile_buckets", """SELECT bucket, count(*) AS n, min(review_count) AS lowest, max(review_count) AS highest FROM (
  SELECT review_count, CAST(greatest(len(list_filter(edges, lambda e: e < review_count)), 1) AS INTEGER) AS bucket
  FROM products, (SELECT list_sort(list_distinct([""" + ", ".join(
      f"quantile_cont(review_count, {i / 5})" for i in range(6)) + """])) AS edges FROM products)) GROUP BY bucket""")
def _(m):
    cut = ranks.quantile_buckets(m.products.select("review_count"), "review_count", 5)
    return cut.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("review_count").alias("lowest"), F.max("review_count").alias("highest")
    )


# ---- order, limit, sample, sets -------------------------------------------------------------

@entry("K1_sort_nulls_last", """SELECT asin, price_cents, position FROM (SELECT asin, price_cents,
  row_number() OVER (ORDER BY price_cents DESC NULLS LAST, asin) AS position FROM products) WHERE position <= 25""")
def _(m):
    first = rel.sort(m.products.select("asin", "price_cents"), "-price_cents", "asin").limit(25)
    nth = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc_nulls_last("price_cents"), "asin"))
    return first.withColumn("position", nth.cast("long"))


@entry("K4_extremes", both_ends("SELECT subcategory, avg_price FROM subcategory_landscape", "avg_price", 3, "subcategory"))
def _(m):
    return rel.extremes(m.subcategory_landscape.select("subcategory", "avg_price"), "avg_price", 3, ["subcategory"])


DRAW = "CAST(('0x' || substr(md5(asin || ':42'), 1, 13)) AS BIGINT) / 4503599627370496.0"


@entry("K6_sample_rows", f"SELECT asin, subcategory FROM products WHERE {DRAW} * 100 < 10")
def _(m):
    return rel.sample_rows(m.products.select("asin", "subcategory"), 10, "asin")


@entry("K7_sample_n", f"SELECT asin, subcategory FROM products ORDER BY {DRAW}, asin LIMIT 500")
def _(m):
    return rel.sample_n(m.products.select("asin", "subcategory"), 500, "asin")


PREVIEW = ["review_date", "review_year", "review_month", "rating", "verified_purchase"]


@entry("K8_preview", f"SELECT {', '.join(PREVIEW)} FROM reviews ORDER BY {', '.join(f'{c} NULLS LAST' for c in PREVIEW)} LIMIT 5")
def _(m):
    return m.reviews.select(*PREVIEW).orderBy(*[F.asc_nulls_last(c) for c in PREVIEW]).limit(5)


@entry("U2_concat", """SELECT asin AS id, 'listing' AS kind FROM listings
  UNION ALL SELECT parent_asin, 'metadata' FROM metadata""")
def _(m):
    return rel.concat(
        m.listings.select(F.col("asin").alias("id"), F.lit("listing").alias("kind")),
        m.metadata.select(F.col("parent_asin").alias("id"), F.lit("metadata").alias("kind")),
    )


@entry("F_scalar_functions", """SELECT parent_asin, length(trim(features)) AS trimmed, lower(title) AS lowered,
  replace(title, ' ', '_') AS joined, len(string_split(title, ' ')) AS words,
  regexp_matches(store, '(?i)store#m') AS is_m, lpad(CAST(rating_tenths AS VARCHAR), 4, '0') AS padded,
  greatest(rating_tenths, rating_number) AS larger, nullif(rating_number, 0) AS nonzero,
  floor(log2(rating_tenths) * 10000 + 0.5) / 10000.0 AS log2_rating,
  floor(pow(rating_tenths, 0.5) * 10000 + 0.5) / 10000.0 AS root,
  try_cast(price AS DOUBLE) AS price_number, coalesce(store, 'none') AS store_or_none,
  rating_tenths BETWEEN 20 AND 40 AS middling, main_category IN ('PROMO', 'LARGE') AS promo_or_large FROM metadata""")
def _(m):
    return m.metadata.select(
        "parent_asin", F.length(F.trim("features")).cast("long").alias("trimmed"), F.lower("title").alias("lowered"),
        F.replace("title", F.lit(" "), F.lit("_")).alias("joined"),
        F.size(F.split("title", " ")).cast("long").alias("words"), F.col("store").rlike("(?i)store#m").alias("is_m"),
        F.lpad(F.col("rating_tenths").cast("string"), 4, "0").alias("padded"),
        F.greatest("rating_tenths", "rating_number").alias("larger"),
        F.nullif("rating_number", F.lit(0)).alias("nonzero"),
        E.half_up(F.log2("rating_tenths"), 10000).alias("log2_rating"),
        E.half_up(F.pow("rating_tenths", F.lit(0.5)), 10000).alias("root"),
        F.col("price").try_cast("double").alias("price_number"),
        F.coalesce("store", F.lit("none")).alias("store_or_none"),
        F.col("rating_tenths").between(20, 40).alias("middling"),
        F.col("main_category").isin("PROMO", "LARGE").alias("promo_or_large"),
    )


@entry("F_date_functions", """SELECT parent_asin, source_category, min(review_date) AS first_review,
  date_diff('day', min(review_date), max(review_date)) AS days,
  date_diff('month', min(review_date), max(review_date)) AS months FROM reviews GROUP BY ALL""")
def _(m):
    first, last = F.min("review_date"), F.max("review_date")
    return m.reviews.groupBy("parent_asin", "source_category").agg(
        first.alias("first_review"), F.datediff(last, first).cast("long").alias("days"),
        C.months_between_dates(first, last).cast("long").alias("months"),
    )


@entry("F_numeric_cleanup", """SELECT parent_asin, source_category,
  coalesce(pct_5star_unverified, 0) AS unverified FROM product_review_trust""")
def _(m):
    return m.product_review_trust.select(
        "parent_asin", "source_category", anomalies.finite("pct_5star_unverified").alias("unverified")
    )


# ---- serving ---------------------------------------------------------------------------------

@entry("Q1_scout_summary", f"""SELECT {CENTS} / 100.0 AS total_revenue, CAST(sum(product_count) AS BIGINT) AS products,
  count(*) AS subcategories, {mean4('avg_rating')} AS avg_rating FROM subcategory_landscape""")
def _(m):
    return serving.scout_summary(m)


@entry("Q2_scout_ecosystem", """SELECT CAST(sum(ecosystem_products) AS BIGINT) AS ecosystem_products,
  CAST(sum(store_count) AS BIGINT) AS stores, CAST(sum(brand_count) AS BIGINT) AS brands, count(*) AS main_categories
  FROM (SELECT * FROM main_category_landscape ORDER BY total_revenue DESC NULLS LAST, main_category LIMIT 33)""")
def _(m):
    return serving.scout_ecosystem(m)


@entry("Q3_P25_category_trend", """SELECT review_year, review_month, make_date(review_year, review_month, 1) AS date,
  review_count, avg_rating, pct_verified, pct_negative FROM temporal_trends
  WHERE source_category = 'PROMO' AND review_year >= 1998""")
def _(m):
    return serving.category_trend(m, "PROMO", 1998)


@entry("Q4_positioning", f"""SELECT subcategory, CAST(sum(product_count) AS BIGINT) AS products,
  {CENTS} / 100.0 AS total_revenue,
  floor(sum({R100} * product_count) / greatest(sum(product_count), 1) / 100 * 10000 + 0.5) / 10000.0 AS weighted_rating,
  first(price_tier ORDER BY avg_revenue_per_product DESC NULLS LAST,
    list_position(['Budget', 'Low', 'Mid', 'Premium', 'Luxury', 'Unknown'], price_tier)) AS winning_tier,
  any_value(brand_multiplier) AS brand_multiplier
  FROM price_positioning LEFT JOIN (
    SELECT subcategory, floor(branded_rev / nullif(unbranded_rev, 0) * 10 + 0.5) / 10.0 AS brand_multiplier
    FROM ({WIDE_BRANDS})) USING (subcategory)
  WHERE subcategory = '{SUB}' GROUP BY subcategory""")
def _(m):
    return serving.positioning(m, SUB)


@entry("Q4_K2_positioning_tiers", f"SELECT * FROM price_positioning WHERE subcategory = '{SUB}'")
def _(m):
    return serving.positioning_tiers(m, SUB)


@entry("Q4_K2_positioning_discounts", f"SELECT * FROM discount_effectiveness WHERE subcategory = '{SUB}'")
def _(m):
    return serving.positioning_discounts(m, SUB)


def _with_models(m):
    """The market with the model tables already written."""
    m.__dict__.update(
        products=stored(m, "products"),
        product_clusters=_assigned(m),
        product_trust_scores=trust_scores(m),
    )
    return m


@entry("Q5_archetype_mix_of")
def _(m):
    return serving.archetype_mix_of(_with_models(m), SUB)


@entry("Q5_A14_archetype_ranks_long")
def _(m):
    return serving.archetype_ranks_long(_with_models(m), SUB)


@entry("Q6_listing_impact", f"SELECT * FROM ({LIFT}) WHERE subcategory = '{SUB}'")
def _(m):
    return serving.listing_impact(m, SUB)


@entry("Q8_health_archetype")
def _(m):
    return serving.health_archetype(_with_models(m), "18")


@entry("Q9_health_diagnosis")
def _(m):
    model = _success(m)[1]
    leaves = once(m, "leaves", lambda: attributions.tree_leaves(model, m.products.sparkSession))
    return serving.health_diagnosis(_with_models(m), model, [ASIN, "7"], leaves=leaves)


@entry("Q10_voice_sentiment", "SELECT * FROM review_sentiment WHERE source_category = 'PROMO'")
def _(m):
    return serving.voice_sentiment(m, "PROMO")


for _side in ("negative", "positive"):
    entry(f"Q10_voice_words_{_side}", top(WORDS.format(_side), "word_count", 20, "word"))(
        lambda m, side=_side: serving.voice_words(m, "PROMO", side))


@entry("Q10_voice_trend", """SELECT review_year, review_month, review_count, avg_rating, pct_negative,
  negative_reviews, positive_reviews, neutral_reviews FROM temporal_trends
  WHERE source_category = 'PROMO' AND review_year >= 1998""")
def _(m):
    return serving.voice_trend(m, "PROMO", 1998)


def _weighted(c):
    return (
        f"floor(sum(CAST(round({c} * 10) AS BIGINT) * total_reviews) / sum(total_reviews) / 10 * 10000 + 0.5) / 10000.0"
    )


@entry("Q11_A15_trust_overview", f"""SELECT CAST(sum(total_reviews) AS BIGINT) AS total_reviews,
  {_weighted('pct_verified')} AS avg_verified, {_weighted('pct_extreme_ratings')} AS avg_extreme,
  count(*) AS categories FROM review_trust""")
def _(m):
    return serving.trust_overview(m)


@entry("Q11_trust_gap_ranking", GAP)
def _(m):
    return serving.trust_gap_ranking(m)


@entry("Q12_trust_summary")
def _(m):
    return serving.trust_summary(_with_models(m))


@entry("Q12_trust_profiles")
def _(m):
    return serving.trust_profiles(_with_models(m), "PROMO")


@entry("Q12_trust_products")
def _(m):
    return serving.trust_products(_with_models(m))


# ---- checks ----------------------------------------------------------------------------------

@entry("D1_require_tables", " UNION ALL ".join(
    f"SELECT 'table {n}' AS \"check\", count(*) > 0 AS passed, CAST(count(*) AS VARCHAR) AS detail FROM {n}"
    for n in ("products", "stores")) + " UNION ALL SELECT 'table nowhere', FALSE, 'missing'")
def _(m):
    return quality.require_tables({"products": m.products, "stores": m.stores}, ["products", "stores", "nowhere"])


@entry("D2_check_rows", "SELECT 'rows' AS \"check\", n = 25 AS passed, CAST(n AS VARCHAR) AS detail "
       "FROM (SELECT count(*) AS n FROM subcategory_landscape)")
def _(m):
    return quality.check_rows(m.subcategory_landscape, 25)


@entry("D3_check_not_null", " UNION ALL ".join(
    f"SELECT 'no nulls in {c}' AS \"check\", count(*) = count({c}) AS passed, "
    f"CAST(count(*) - count({c}) AS VARCHAR) AS detail FROM products"
    for c in ("asin", "subcategory", "price_cents", "store")))
def _(m):
    return quality.check_not_null(m.products, ["asin", "subcategory", "price_cents", "store"])


@entry("D3_D8_check_columns", """SELECT 'column review_year' AS "check", count(review_year) > 0 AS passed,
  CAST(count(review_year) AS VARCHAR) AS detail FROM temporal_trends
  UNION ALL SELECT 'column bought_together', FALSE, 'missing'""")
def _(m):
    return quality.check_columns(m.temporal_trends, ["review_year", "bought_together"])


@entry("D4_check_range", """SELECT 'avg_rating in range' AS "check", min(avg_rating) >= 0 AND max(avg_rating) <= 5 AS passed,
  min(avg_rating) || '..' || max(avg_rating) AS detail FROM subcategory_landscape""")
def _(m):
    return quality.check_range(m.subcategory_landscape, "avg_rating", 0, 5)


@entry("D5_check_cardinality", """SELECT 'distinct review_year' AS "check", count(DISTINCT review_year) >= 5 AS passed,
  CAST(count(DISTINCT review_year) AS VARCHAR) AS detail FROM temporal_trends""")
def _(m):
    return quality.check_cardinality(m.temporal_trends, "review_year", 5, at_least=True)


@entry("D6_check_rate")
def _(m):
    return quality.check_rate(trust_scores(m), "is_suspicious", 2, 10)


@entry("D7_flag_totals", "SELECT count(*) AS total, " + ", ".join(
    f"count(*) FILTER (WHERE {f}) AS {f}"
    for f in ("flag_no_price", "flag_no_reviews", "flag_no_sales", "flag_no_rating", "flag_no_title"))
    + " FROM products")
def _(m):
    return quality.flag_totals(m.products)


@entry("D7_rows_by", "SELECT source_category, count(*) AS rows FROM reviews GROUP BY source_category")
def _(m):
    return quality.rows_by(m.reviews, "source_category")


# ---- sources: tables go out as raw files and come back through the readers -------------------

def _csv_out(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return path


@raw_entry("S1_read_categories", """SELECT id, category_name, 0 AS flag_missing_name,
  length(trim(category_name)) AS name_length FROM categories""")
def _(spark, sf_dir):
    return readers.read_categories(spark, _csv_out(roles.categories(spark, sf_dir), "categories"))


@raw_entry("S2_U1_read_metadata", """SELECT * EXCLUDE (categories_text), categories_text AS categories,
  (price IS NULL OR price IN ('', '—')) AS flag_no_price, (store IS NULL OR store = '') AS flag_no_store,
  (details_brand IS NULL OR details_brand = '') AS flag_no_brand, (title IS NULL OR title = '') AS flag_no_title,
  coalesce(rating_number = 0, FALSE) AS flag_no_ratings FROM metadata""")
def _(spark, sf_dir):
    raw = roles.metadata(spark, sf_dir).withColumn("average_rating", F.col("rating_tenths") / 10.0)
    listed = F.col("parent_asin").startswith("X")
    columns = [f.name for f in schemas.METADATA.fields]
    paths = [_csv_out(raw.where(w).select(*columns), "metadata") for w in (listed, ~listed)]
    return readers.union_all(spark, paths, readers.read_metadata)


@raw_entry("S3_P6_read_listings", """SELECT asin, title, category_id, price_cents, list_cents, rating_tenths,
  review_count, bought_last_month, is_best_seller, coalesce(price_cents = 0, TRUE) AS flag_no_price,
  review_count = 0 AS flag_no_reviews, bought_last_month = 0 AS flag_no_sales, rating_tenths = 0 AS flag_no_rating,
  trim(title) = '' AS flag_no_title FROM listings""")
def _(spark, sf_dir):
    raw = roles.listings(spark, sf_dir).select(
        "asin", "title", F.lit(None).cast("string").alias("imgUrl"), F.lit(None).cast("string").alias("productURL"),
        (F.col("rating_tenths") / 10.0).alias("stars"), F.col("review_count").alias("reviews"),
        (F.col("price_cents").cast("decimal(18,2)") / 100).cast("decimal(18,2)").alias("price"),
        (F.col("list_cents").cast("decimal(18,2)") / 100).cast("decimal(18,2)").alias("listPrice"),
        "category_id", F.col("is_best_seller").alias("isBestSeller"),
        F.col("bought_last_month").alias("boughtInLastMonth"),
    )
    return readers.read_listings(spark, _csv_out(raw, "listings"))


def _review_lines(df: DataFrame) -> DataFrame:
    """Reviews as the JSON lines they would arrive as."""
    image = F.struct(F.lit("s.jpg").alias("small_image_url"))
    record = F.struct(
        "rating", "title", "text", F.array_repeat(image, F.col("image_count").cast("int")).alias("images"),
        "asin", "parent_asin", "user_id", "timestamp", "helpful_vote", "verified_purchase",
    )
    return df.select(F.to_json(record).alias("value"), "source_category")


FILE_LINES = 500_000  # lines of a compressed file, which one task reads


def _review_files(df: DataFrame) -> str:
    """Lines in compressed files, a folder for each category.  A task keeps the files of up to 64 categories open, so that
    lines are not sorted, and spilled, by category first."""
    spark, setting = df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    path, before = scratch_path(spark, "reviews"), spark.conf.get(setting)
    spark.conf.set(setting, 64)
    try:
        df.write.partitionBy("source_category").option("maxRecordsPerFile", FILE_LINES).option(
            "zlib.compress.level", "BEST_SPEED").text(path, compression="gzip")
    finally:
        spark.conf.set(setting, before)
    return path


READ_BACK = """SELECT source_category, parent_asin, count(*) AS reviews, sum(rating) AS stars,
  CAST(sum(image_count) AS BIGINT) AS images, count(*) FILTER (WHERE has_text) AS with_text,
  CAST(sum(text_length) AS BIGINT) AS characters, count(*) FILTER (WHERE verified_purchase) AS verified,
  CAST(sum(helpful_vote) AS BIGINT) AS votes, min(review_date) AS first_review FROM reviews GROUP BY ALL"""


def _read_back(df: DataFrame) -> DataFrame:
    return silver.reviews(df).groupBy("source_category", "parent_asin").agg(
        F.count(F.lit(1)).alias("reviews"), F.sum("rating").alias("stars"), F.sum("image_count").alias("images"),
        F.count_if("has_text").alias("with_text"), F.sum("text_length").alias("characters"),
        F.count_if("verified_purchase").alias("verified"), F.sum("helpful_vote").alias("votes"),
        F.min("review_date").alias("first_review"),
    )


@raw_entry("S4_P4_read_reviews", READ_BACK)
def _(spark, sf_dir):
    path = _review_files(_review_lines(roles.reviews(spark, sf_dir)))
    return _read_back(readers.read_reviews(spark, path))


@raw_entry("S5_bad_records", """SELECT source_category, count(*) AS reviews,
  count(*) FILTER (WHERE parent_asin LIKE 'U%') AS lost FROM reviews GROUP BY source_category""")
def _(spark, sf_dir):
    """Every review, plus a broken line for each review of an unlisted product."""
    reviews = roles.reviews(spark, sf_dir)
    broken = reviews.where(F.col("parent_asin").startswith("U")).select(
        F.concat(F.lit('{"rating": 5, "parent_asin": "'), "parent_asin").alias("value"), "source_category"
    )
    path = _review_files(rel.concat(_review_lines(reviews), broken))
    kept = readers.read_reviews(spark, path, bad_records="keep")
    return kept.groupBy("source_category").agg(
        F.count_if(F.col(readers.CORRUPT).isNull()).alias("reviews"),
        F.count_if(F.col(readers.CORRUPT).isNotNull()).alias("lost"),
    )


@raw_entry("S6_append_reviews", READ_BACK)
def _(spark, sf_dir):
    """A first load, and a late one that runs twice."""
    reviews = roles.reviews(spark, sf_dir)
    late = F.col("source_category") == "MISC"
    path = scratch_path(spark, "appended")
    tables.append_reviews(reviews.where(~late), path, "first")
    for _ in range(2):
        tables.append_reviews(reviews.where(late), path, "late")
    return _read_back(spark.read.parquet(path))


def _refreshed(m: Market, name: str) -> DataFrame:
    """Reviews in five loads cut across products and months; the second runs three times, first with other reviews."""
    spark = m.raw_reviews.sparkSession
    folder = once(m, "refreshed", lambda: scratch_path(spark, "refreshed"))
    if not folder_exists(spark, folder):
        # Cut into loads once, a folder each; partials read no texts.
        numbered = m.raw_reviews.withColumn("number", F.pmod(F.xxhash64("text", "timestamp"), F.lit(5)).cast("int")).drop("text", "title")
        reviews = tables.materialize(numbered, scratch_path(spark, "loads"), partition_by=["number"])
        number = F.col("number")
        for load, rows in [(0, number == 0), (1, number == 3), (1, number == 1), (2, number == 2), (3, number == 3), (1, number == 1), (4, number == 4)]:
            summaries.add_load(reviews.where(rows), folder, f"load-{load}", m.listings, m.recent_since, m.trend_years)
    return summaries.table(spark, folder, name)


for _id, _name in [("G20", "temporal_trends"), ("G16", "product_review_summary")]:
    entry(f"{_id}_S4_refreshed_{_name}", f"SELECT * FROM {_name}")(lambda m, n=_name: _refreshed(m, n))


@entry("S7_S9_materialize", "SELECT * FROM brand_dynamics")
def _(m):
    df = m.brand_dynamics
    path = scratch_path(df.sparkSession, "brand_dynamics")
    tables.materialize(df.limit(1), path)
    return tables.materialize(df, path)


BUCKETS = 64


def _bucketed_reviews(m) -> DataFrame:
    """Every review, with every column but the text itself: its length and presence are what summaries and trust read."""
    def make():
        spark = m.reviews.sparkSession
        name = f"bucketed_reviews_{len(_STORED)}"
        return tables.materialize_bucketed(m.reviews.drop("text"), scratch_path(spark, "bucketed"), name, ["parent_asin"], BUCKETS)

    return once(m, "bucketed_reviews", make)


@entry("S7_G16_from_buckets", "SELECT * FROM product_review_summary")
def _(m):
    return gr.product_review_summary(_bucketed_reviews(m), m.listings, m.recent_since)


@entry("S7_G17_from_buckets", "SELECT * FROM product_review_trust")
def _(m):
    return gr.product_review_trust(_bucketed_reviews(m), m.listings)


@entry("S7_J7_from_buckets", """SELECT parent_asin, source_category, t.review_count, s.review_span_days, s.pct_negative
  FROM product_review_trust t JOIN product_review_summary s USING (parent_asin, source_category) WHERE t.review_count >= 5""")
def _(m):
    reviews = _bucketed_reviews(m)
    trust = gr.product_review_trust(reviews, m.listings)
    return gr.join_trust(trust, gr.product_review_summary(reviews, m.listings, m.recent_since)).select(
        "parent_asin", "source_category", "review_count", "review_span_days", "pct_negative"
    )


@entry("S8_define_view", "SELECT source_category, count(*) AS n FROM reviews WHERE rating = 5 GROUP BY source_category")
def _(m):
    tables.define_view(m.reviews, "silver_reviews")
    return m.reviews.sparkSession.sql(
        "SELECT source_category, count(*) AS n FROM silver_reviews WHERE rating = 5 GROUP BY source_category"
    )


TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@raw_entry("S10_load_tables", " UNION ALL ".join(
    f"SELECT '{n}' AS name, count(*) AS rows FROM {n}" for n in TABLE_NAMES))
def _(spark, sf_dir):
    found = tables.load_tables(spark, sf_dir)
    return rel.concat(*[
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows") for n, df in found.items()
    ])


@entry("S11_export_gold", "SELECT * FROM review_trust")
def _(m):
    folder = scratch_path(m.review_trust.sparkSession, "gold")
    tables.export_gold({"review_trust": m.review_trust, "brand_dynamics": m.brand_dynamics}, folder)
    return tables.load_tables(m.review_trust.sparkSession, folder)["review_trust"]


@entry("S12_persist_scores")
def _(m):
    scores = trust_scores(m)
    return tables.materialize(scores, scratch_path(scores.sparkSession, "scores"))


@raw_entry("S13_bench_read")
def _(spark, sf_dir):
    return tables.bench_read(roles.table(spark, sf_dir, "lineitem"))


@raw_entry("S14_profile_files")
def _(spark, sf_dir):
    return tables.profile_files(roles.table(spark, sf_dir, "lineitem"))


@raw_entry("S14_file_rows", "SELECT 'lineitem' AS table_name, count(*) AS rows FROM lineitem")
def _(spark, sf_dir):
    per_file = tables.profile_files(roles.table(spark, sf_dir, "lineitem"))
    return per_file.agg(F.sum("rows").alias("rows")).select(F.lit("lineitem").alias("table_name"), "rows")


SCHEMAS = {
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
        "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
        "l_shipdate": "timestamp_ntz",
    },
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
}


def _schema_sql(table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {i} AS position, '{c}' AS column_name, '{t}' AS column_type, count({c}) AS non_null FROM {table}"
        for i, (c, t) in enumerate(SCHEMAS[table].items()))


@raw_entry("S14_profile_schema", " UNION ALL ".join(map(_schema_sql, SCHEMAS)))
def _(spark, sf_dir):
    """Every column of the tables."""
    return rel.concat(*[
        tables.profile_schema(roles.table(spark, sf_dir, t)).select(F.lit(t).alias("table_name"), "*") for t in SCHEMAS
    ])


@raw_entry("S14_raw_profile", """SELECT 'csv' AS kind, CAST(1 AS BIGINT) AS files
  UNION ALL SELECT 'json lines', 2 UNION ALL SELECT 'parquet', 1""")
def _(spark, sf_dir):
    """A folder of raw files, written from the tables: one CSV, two files of JSON lines, one Parquet file."""
    path = scratch_path(spark, "raw")
    nation, region = roles.table(spark, sf_dir, "nation").coalesce(1), roles.table(spark, sf_dir, "region").coalesce(1)
    nation.write.option("header", True).csv(f"{path}/csv")
    nation.write.json(f"{path}/json")
    region.write.json(f"{path}/more")
    region.write.parquet(f"{path}/parquet")
    return tables.raw_profile(spark, path).select("kind", "files")


@raw_entry("S14_readable_files", """SELECT 'csv' AS kind, count(*) + 1 AS lines, CAST(0 AS BIGINT) AS bad_lines, TRUE AS readable FROM nation
  UNION ALL SELECT 'json lines', count(*), 0, TRUE FROM nation UNION ALL SELECT 'csv', count(*), 0, FALSE FROM region""")
def _(spark, sf_dir):
    """A CSV file, a file of JSON lines, and a CSV file of which each line opens a quote."""
    path = scratch_path(spark, "raw")
    nation, region = roles.table(spark, sf_dir, "nation").coalesce(1), roles.table(spark, sf_dir, "region").coalesce(1)
    nation.write.option("header", True).csv(f"{path}/csv")
    nation.write.json(f"{path}/json")
    region.select(F.concat(F.lit('"'), "r_name")).write.option("quote", "\u0000").csv(f"{path}/open")
    return tables.readable_files(spark, path).select("kind", "lines", "bad_lines", "readable")
