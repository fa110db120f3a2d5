"""The same tables stated in SQL, for an independent engine to check against.

``TABLES`` maps a table to its SELECT; ``query(select)`` puts the tables a
statement needs in front of it as WITH clauses.
"""

from __future__ import annotations

import re

TABLES: dict[str, str] = {}


def table(name: str, sql: str) -> None:
    TABLES[name] = sql


def query(select: str, **extra: str) -> str:
    """Prefix a SELECT with the WITH clauses it refers to, in dependency order."""
    known = {**TABLES, **extra}
    order: list[str] = []

    def visit(sql: str, seen: tuple) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_0-9]+\b", sql)):
            if word in known and word not in order and word not in seen:
                visit(known[word], (*seen, word))
                order.append(word)

    visit(select, ())
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in order) + "\n" + select


# ---- rounded statistics, divided once ---------------------------------------

def only(where):
    return f" FILTER (WHERE {where})" if where else ""


def ratio(num, den, mul=1, div=1):
    return f"floor((({num}) * {mul}) / nullif({den}, 0) + 0.5) / {div}.0"


def mean(c, mul, div, where=None):
    return ratio(f"sum({c}){only(where)}", f"count({c}){only(where)}", mul, div)


def money(c, where=None):
    return mean(c, 1, 100, where)


def stars10(c, where=None):
    return mean(c, 10, 100, where)


def whole(c, where=None):
    return mean(c, 10, 10, where)


def pct(cond, dp=1):
    return ratio(f"count(*){only(cond)}", "count(*)", 100 * 10**dp, 10**dp)


def pct_of(cond, base, dp=1):
    return ratio(
        f"count(*){only(f'({base}) AND ({cond})')}", f"count(*){only(base)}", 100 * 10**dp, 10**dp
    )


def pct_sum(c):
    return ratio(f"sum({c})", "count(*)", 1000, 10)


def rated(c, per):
    return ratio(f"sum(CAST(round({c} * {per}) AS BIGINT))", f"count({c})", 1, per)


def big(x):
    return f"CAST({x} AS BIGINT)"


def half_up(x, scale):
    return f"floor(({x}) * {scale} + 0.5) / {scale}.0"


def quart(c, name, scale, per):
    out = []
    for q in (25, 50, 75):
        value = f"quantile_cont({c}, {q / 100})"
        out.append(f"floor({value} * {scale} + 0.5) / {scale}.0 / {per}.0 AS {name}_p{q}")
    return ", ".join(out)


# ---- inputs ------------------------------------------------------------------

table("categories", """
SELECT DISTINCT CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) AS id,
  p_brand AS category_name FROM part""")

table("listings", """
SELECT CAST(p_partkey AS VARCHAR) AS asin,
  repeat(p_name || ' ', CAST(1 + p_partkey % 16 AS BIGINT)) AS title,
  CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) AS category_id,
  CASE WHEN p_partkey % 50 <> 7 THEN pc END AS price_cents,
  CASE WHEN p_partkey % 9 = 4 THEN 0
    ELSE CAST(floor(pc * (100 + 15 * (p_partkey % 10)) / 100) AS BIGINT) END AS list_cents,
  CASE WHEN p_partkey % 23 = 5 THEN 0 ELSE s10 END AS rating_tenths,
  CASE WHEN p_partkey % 4 = 1 THEN 0 ELSE coalesce(returned, 0) END AS review_count,
  coalesce(sold, 0) AS bought_last_month,
  p_partkey % 37 = 0 AS is_best_seller
FROM (SELECT *, CAST(floor(CAST(round(p_retailprice * 10) AS BIGINT) * p_size / 40) AS BIGINT) AS pc
      FROM part)
LEFT JOIN (
  SELECT l_partkey,
    CAST(coalesce(sum(l_quantity) FILTER (WHERE l_shipdate >= DATE '2001-08-01'), 0) AS BIGINT) AS sold,
    count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
    CAST(floor(avg(10 + 10 * (CAST(l_quantity AS BIGINT) % 5))) AS BIGINT) AS s10
  FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey""")

table("metadata", """
SELECT parent_asin,
  CASE WHEN p_partkey % 15 <> 3 THEN p_type END AS main_category,
  p_name AS title,
  10 + (p_partkey * 7) % 41 AS rating_tenths,
  CASE WHEN p_partkey % 19 = 0 THEN NULL WHEN p_partkey % 6 = 0 THEN 0
    ELSE CAST(p_size AS BIGINT) * (p_partkey % 13) END AS rating_number,
  CASE WHEN p_partkey % 3 = 0 THEN '—' WHEN p_partkey % 13 = 0 THEN 'from 12'
    WHEN p_partkey % 17 = 0 THEN '$1,234.50' ELSE '$' || p_size || '.25' END AS price,
  CASE WHEN p_partkey % 11 = 2 THEN NULL
    WHEN p_partkey % 3 = 0 THEN 'Store#' || (p_partkey % 20)
    WHEN p_partkey % 3 = 1 THEN 'Store#M' || CAST(p_partkey // 12 AS BIGINT)
    ELSE 'Store#S' || p_partkey END AS store,
  CASE p_partkey % 4 WHEN 0 THEN '[]' WHEN 1 THEN '  ' ELSE p_name END AS features,
  CASE WHEN p_partkey % 6 <> 0 THEN p_type END AS description,
  '[''' || p_type || ''']' AS categories_text,
  CASE WHEN p_partkey % 5 >= 3 THEN p_brand END AS details_brand,
  CASE WHEN p_partkey % 7 <> 0 THEN 'Maker of ' || p_brand END AS details_manufacturer
FROM (
  SELECT 'X' || p_partkey AS parent_asin, * FROM part
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), * FROM part WHERE p_size <= 14)""")

table("reviews", """
SELECT CAST(1 + CAST(l_quantity AS BIGINT) % 5 AS DOUBLE) AS rating,
  p_name AS title,
  text, doc_id,
  CAST(l_partkey AS VARCHAR) AS asin,
  CASE WHEN l_linenumber = 7 THEN 'U' ELSE '' END || l_partkey AS parent_asin,
  CAST(o_custkey AS VARCHAR) AS user_id,
  epoch_ms(l_shipdate) AS timestamp,
  CAST(l_shipdate AS DATE) AS review_date,
  year(l_shipdate) AS review_year,
  month(l_shipdate) AS review_month,
  CAST(l_linenumber - 1 AS BIGINT) AS helpful_vote,
  l_returnflag <> 'N' AS verified_purchase,
  CAST(l_linenumber % 3 AS BIGINT) AS image_count,
  CASE WHEN l_linenumber = 1 AND l_returnflag = 'N' THEN 'MISC' ELSE p_type END AS source_category,
  length(text) AS text_length,
  coalesce(text <> '', FALSE) AS has_text,
  coalesce(p_name <> '', FALSE) AS has_title,
  l_linenumber - 1 > 0 AS has_helpful_votes
FROM lineitem
JOIN part ON p_partkey = l_partkey
JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN documents ON doc_id = l_orderkey % (
  SELECT count(*) + count(*) // 10 FROM documents)""")

# ---- silver ------------------------------------------------------------------

FILLED = "coalesce(trim({0}) NOT IN ('', '[]'), FALSE)"
LACKS = "({0} IS NULL OR {0} = {1})"

table("products", f"""
SELECT asin, category_name AS subcategory, main_category, li.title, price_cents, list_cents,
  CASE WHEN price_cents > 0 AND list_cents > price_cents
    THEN CAST(floor(1000 * (list_cents - price_cents) / list_cents + 0.5) AS BIGINT) END AS discount_tenths,
  li.rating_tenths, review_count, is_best_seller, bought_last_month,
  price_cents * bought_last_month AS revenue_cents,
  CASE WHEN price_cents >= 10000 THEN 'Luxury' WHEN price_cents >= 5000 THEN 'Premium'
    WHEN price_cents >= 2500 THEN 'Mid' WHEN price_cents >= 1000 THEN 'Low'
    WHEN price_cents IS NOT NULL THEN 'Budget' ELSE 'Unknown' END AS price_tier,
  store, details_brand AS brand, details_manufacturer AS manufacturer, features, description,
  categories_text AS metadata_categories,
  length(li.title) AS title_length,
  {FILLED.format('features')}::INTEGER AS has_features,
  {FILLED.format('description')}::INTEGER AS has_description,
  (store IS NOT NULL)::INTEGER AS has_store,
  (details_brand IS NOT NULL)::INTEGER AS has_brand,
  (parent_asin IS NOT NULL)::INTEGER AS is_matched,
  {LACKS.format('price_cents', 0)} AS flag_no_price,
  {LACKS.format('review_count', 0)} AS flag_no_reviews,
  {LACKS.format('bought_last_month', 0)} AS flag_no_sales,
  {LACKS.format('li.rating_tenths', 0)} AS flag_no_rating,
  (li.title IS NULL OR trim(li.title) = '') AS flag_no_title
FROM listings li
LEFT JOIN categories ON category_id = id
LEFT JOIN metadata ON parent_asin = asin""")

table("products_full", f"""
SELECT parent_asin, main_category, title, rating_tenths, rating_number AS review_count,
  CAST(round(try_cast(replace(replace(nullif(price, '—'), '$', ''), ',', '') AS DOUBLE) * 100) AS BIGINT)
    AS price_cents,
  store, details_brand AS brand, details_manufacturer AS manufacturer, features, description,
  categories_text AS categories, length(title) AS title_length,
  (store IS NOT NULL)::INTEGER AS has_store,
  (details_brand IS NOT NULL)::INTEGER AS has_brand,
  {FILLED.format('features')}::INTEGER AS has_features,
  {FILLED.format('description')}::INTEGER AS has_description,
  (price IS NULL OR price IN ('', '—')) AS flag_no_price,
  {LACKS.format('store', "''")} AS flag_no_store,
  {LACKS.format('details_brand', "''")} AS flag_no_brand,
  {LACKS.format('title', "''")} AS flag_no_title,
  coalesce(rating_number = 0, FALSE) AS flag_no_ratings
FROM metadata WHERE main_category IS NOT NULL""")

table("category_profile", f"""
SELECT main_category, count(*) AS product_count,
  count(DISTINCT store) AS store_count, count(DISTINCT brand) AS brand_count,
  {stars10('rating_tenths')} AS avg_rating, {whole('review_count')} AS avg_reviews,
  {money('price_cents')} AS avg_price,
  floor(median(price_cents) + 0.5) / 100.0 AS median_price,
  {pct_sum('has_features')} AS pct_with_features,
  {pct_sum('has_description')} AS pct_with_description,
  {pct_sum('has_brand')} AS pct_with_brand, {pct_sum('has_store')} AS pct_with_store
FROM products_full GROUP BY main_category""")

table("stores", f"""
SELECT store, count(*) AS product_count,
  count(DISTINCT main_category) AS category_count, count(DISTINCT brand) AS brand_count,
  {stars10('rating_tenths')} AS avg_rating, {whole('review_count')} AS avg_reviews,
  {big('sum(has_features)')} AS products_with_features,
  {big('sum(has_description)')} AS products_with_description,
  CASE count(DISTINCT main_category) WHEN 1 THEN 'Specialist' WHEN 2 THEN 'Focused'
    WHEN 3 THEN 'Focused' ELSE 'Generalist' END AS store_type
FROM products_full WHERE store IS NOT NULL GROUP BY store""")

# ---- gold, listings ------------------------------------------------------------

OUTCOMES = f"""count(*) AS product_count, {money('price_cents')} AS avg_price,
  {stars10('rating_tenths')} AS avg_rating, {whole('review_count')} AS avg_reviews,
  {big('sum(bought_last_month)')} AS total_units_sold,
  sum(revenue_cents) / 100.0 AS total_revenue,
  {money('revenue_cents')} AS avg_revenue_per_product,
  {pct('bought_last_month > 0')} AS pct_active, {pct('is_best_seller')} AS pct_best_sellers"""
MEDIAN_PRICE = "floor(median(price_cents) + 0.5) / 100.0 AS median_price"
DISCOUNT = mean("discount_tenths", 1, 10)

table("subcategory_landscape", f"""
SELECT subcategory, {OUTCOMES}, {MEDIAN_PRICE},
  {pct('review_count = 0')} AS pct_zero_reviews, {DISCOUNT} AS avg_discount_pct,
  {pct_sum('has_brand')} AS pct_with_brand, {pct_sum('has_features')} AS pct_with_features,
  {pct_sum('has_description')} AS pct_with_description, {pct_sum('has_store')} AS pct_with_store
FROM products GROUP BY subcategory""")

table("main_category_landscape", f"""
SELECT c.main_category, c.product_count AS ecosystem_products, store_count, brand_count,
  listed_products, {ratio('listed_products', 'c.product_count', 10000, 100)} AS listing_coverage_pct,
  total_units_sold, cents / 100.0 AS total_revenue, avg_revenue_per_product, l.avg_price,
  l.avg_rating, pct_active,
  {ratio('c.product_count', 'store_count', 10, 10)} AS products_per_store,
  {ratio('cents', 'store_count', 1, 100)} AS revenue_per_store,
  pct_with_features, pct_with_description, pct_with_brand, pct_with_store
FROM category_profile c LEFT JOIN (
  SELECT main_category, count(*) AS listed_products,
    {big('sum(bought_last_month)')} AS total_units_sold, {big('sum(revenue_cents)')} AS cents,
    {money('revenue_cents')} AS avg_revenue_per_product, {money('price_cents')} AS avg_price,
    {stars10('rating_tenths')} AS avg_rating, {pct('bought_last_month > 0')} AS pct_active
  FROM products WHERE main_category IS NOT NULL GROUP BY main_category) l USING (main_category)""")

table("price_positioning", f"""
SELECT subcategory, price_tier, {OUTCOMES}, {MEDIAN_PRICE}, {DISCOUNT} AS avg_discount_pct,
  {pct_sum('has_brand')} AS pct_branded, {whole('title_length')} AS avg_title_length,
  {pct_sum('has_features')} AS pct_with_features
FROM products GROUP BY subcategory, price_tier""")

table("brand_dynamics", f"""
SELECT subcategory, if(has_brand = 1, 'Branded', 'Unbranded') AS brand_status, {OUTCOMES},
  {DISCOUNT} AS avg_discount_pct
FROM products GROUP BY ALL""")

table("discount_effectiveness", f"""
SELECT subcategory,
  CASE WHEN coalesce(discount_tenths, 0) <= 0 THEN 'No Discount'
    WHEN discount_tenths >= 500 THEN 'Deep (50%+)'
    WHEN discount_tenths >= 200 THEN 'Medium (20-49%)' ELSE 'Light (1-19%)' END AS discount_tier,
  {OUTCOMES}, {DISCOUNT} AS avg_discount
FROM products WHERE list_cents > 0 GROUP BY ALL""")


def _split(part):
    return (
        f"{money('revenue_cents', f'has_{part} = 1')} AS avg_rev_with_{part}, "
        f"{money('revenue_cents', f'has_{part} = 0')} AS avg_rev_without_{part}"
    )


PARTS = "(has_features + has_description + has_brand + has_store)"

table("listing_quality", f"""
SELECT subcategory, count(*) AS product_count, {whole('title_length')} AS avg_title_length,
  floor(median(title_length) * 10 + 0.5) / 10.0 AS median_title_length,
  {pct_sum('has_features')} AS pct_with_features,
  {pct_sum('has_description')} AS pct_with_description,
  {pct_sum('has_brand')} AS pct_with_brand, {pct_sum('has_store')} AS pct_with_store,
  {_split('features')}, {_split('description')}, {_split('brand')},
  {money('revenue_cents', 'title_length < 50')} AS avg_rev_short_title,
  {money('revenue_cents', 'title_length >= 50 AND title_length <= 100')} AS avg_rev_medium_title,
  {money('revenue_cents', 'title_length >= 100 AND title_length <= 150')} AS avg_rev_long_title,
  {money('revenue_cents', 'title_length > 150')} AS avg_rev_very_long_title,
  {mean(PARTS, 100, 100)} AS avg_completeness_score,
  {money('revenue_cents', f'{PARTS} IN (3, 4)')} AS avg_rev_high_completeness,
  {money('revenue_cents', f'{PARTS} IN (0, 1)')} AS avg_rev_low_completeness
FROM products GROUP BY subcategory""")


def _badge(name, f, c):
    return (
        f"{f(c, 'is_best_seller')} AS {name}_bestseller, "
        f"{f(c, 'NOT is_best_seller')} AS {name}_non_bestseller"
    )


table("bestseller_analysis", f"""
SELECT subcategory, count(*) AS total_products,
  count(*) FILTER (WHERE is_best_seller) AS bestseller_count,
  {pct('is_best_seller', 2)} AS pct_bestsellers,
  {_badge('avg_price', money, 'price_cents')}, {_badge('avg_rating', stars10, 'rating_tenths')},
  {_badge('avg_reviews', whole, 'review_count')}, {_badge('avg_rev', money, 'revenue_cents')},
  {_badge('avg_sales', whole, 'bought_last_month')},
  {ratio("coalesce(sum(revenue_cents) FILTER (WHERE is_best_seller), 0)", "sum(revenue_cents)", 1000, 10)}
    AS pct_revenue_from_bestsellers,
  {half_up("avg(revenue_cents) FILTER (WHERE is_best_seller) / nullif(avg(revenue_cents) FILTER (WHERE NOT is_best_seller), 0)", 10)}
    AS bestseller_revenue_multiplier
FROM products GROUP BY subcategory""")

BENCHMARKS = ", ".join([
    quart("price_cents", "price", 1, 100), quart("review_count", "reviews", 1, 1),
    quart("rating_tenths", "rating", 10, 10), quart("bought_last_month", "sales", 1, 1),
    quart("revenue_cents", "revenue", 1, 100),
])

table("product_benchmarks", f"""
SELECT subcategory, count(*) AS product_count, {BENCHMARKS}
FROM products WHERE price_cents IS NOT NULL GROUP BY subcategory""")

table("category_benchmarks_full", f"""
SELECT subcategory, count(*) AS product_count, {BENCHMARKS},
  {whole('title_length')} AS avg_title_length,
  {pct_sum('has_features')} AS pct_with_features,
  {pct_sum('has_description')} AS pct_with_description,
  {pct_sum('has_brand')} AS pct_with_brand, {DISCOUNT} AS avg_discount_pct,
  {rated('s.avg_rating', 100)} AS avg_review_rating, {rated('s.pct_verified', 10)} AS avg_pct_verified,
  {rated('s.pct_negative', 10)} AS avg_pct_negative,
  {rated('s.reviews_per_month', 100)} AS avg_reviews_per_month,
  {rated('s.avg_text_length', 10)} AS avg_review_text_length,
  count(s.parent_asin) AS products_with_reviews
FROM (SELECT * EXCLUDE (review_count), review_count FROM products) p
LEFT JOIN (SELECT * EXCLUDE (review_count) FROM product_review_summary) s ON s.parent_asin = p.asin
GROUP BY subcategory""")

table("store_performance", f"""
SELECT s.store, store_type, s.product_count AS ecosystem_products, category_count, brand_count,
  s.avg_rating AS ecosystem_avg_rating, s.avg_reviews AS ecosystem_avg_reviews,
  p.* EXCLUDE (store)
FROM stores s JOIN (
  SELECT store, count(asin) AS listed_products, {money('price_cents')} AS avg_price,
    sum(revenue_cents) / 100.0 AS total_revenue,
    {money('revenue_cents')} AS avg_revenue_per_product,
    {big('sum(bought_last_month)')} AS total_units_sold,
    {ratio('count(*) FILTER (WHERE bought_last_month > 0)', 'count(asin)', 1000, 10)} AS pct_active,
    {stars10('rating_tenths')} AS avg_rating, {whole('review_count')} AS avg_reviews
  FROM products GROUP BY store) p USING (store)""")

# ---- gold, reviews ---------------------------------------------------------------

STARS = mean("rating", 100, 100)
TEXT = mean("text_length", 10, 10, "has_text")

table("listed_reviews", "SELECT * FROM reviews WHERE parent_asin IN (SELECT asin FROM listings)")

table("product_review_summary", f"""
SELECT parent_asin, source_category, count(*) AS review_count, {STARS} AS avg_rating,
  median(rating) AS median_rating,
  min(review_date) AS first_review_date, max(review_date) AS last_review_date,
  date_diff('day', min(review_date), max(review_date)) AS review_span_days,
  {ratio('count(*)', "greatest(date_diff('month', min(review_date), max(review_date)), 1)", 100, 100)}
    AS reviews_per_month,
  count(*) FILTER (WHERE rating >= 4) AS positive_count,
  count(*) FILTER (WHERE rating = 3) AS neutral_count,
  count(*) FILTER (WHERE rating <= 2) AS negative_count,
  {pct('rating >= 4')} AS pct_positive, {pct('rating <= 2')} AS pct_negative,
  {pct('verified_purchase')} AS pct_verified,
  {mean('helpful_vote', 100, 100)} AS avg_helpful_vote,
  {big('sum(helpful_vote)')} AS total_helpful_votes,
  {pct('image_count > 0')} AS pct_with_images, {TEXT} AS avg_text_length,
  count(*) FILTER (WHERE review_date >= DATE '2000-01-01') AS reviews_since,
  {mean('rating', 100, 100, "review_date >= DATE '2000-01-01'")} AS avg_rating_since
FROM listed_reviews GROUP BY parent_asin, source_category""")

table("product_review_trust", f"""
SELECT parent_asin, source_category, count(*) AS review_count,
  count(DISTINCT user_id) AS unique_reviewers,
  {ratio('count(*)', 'count(DISTINCT user_id)', 100, 100)} AS reviews_per_reviewer,
  {pct('rating IN (1, 5)')} AS pct_extreme_ratings, {pct('rating = 5')} AS pct_5star,
  {pct('rating = 1')} AS pct_1star, {pct('verified_purchase')} AS pct_verified,
  {pct_of('rating = 5', 'NOT verified_purchase')} AS pct_5star_unverified,
  {pct_of('rating = 5', 'verified_purchase')} AS pct_5star_verified,
  {pct('has_text')} AS pct_with_text, {TEXT} AS avg_text_length,
  {pct('has_text AND text_length < 20')} AS pct_very_short_text,
  {ratio('count(*)', "greatest(date_diff('day', min(review_date), max(review_date)), 1)", 10000, 10000)}
    AS reviews_per_day,
  {pct('helpful_vote > 0')} AS pct_with_helpful_votes
FROM listed_reviews GROUP BY parent_asin, source_category""")

table("review_trust", f"""
SELECT source_category, count(*) AS total_reviews, count(DISTINCT user_id) AS unique_reviewers,
  {ratio('count(*)', 'count(DISTINCT user_id)', 100, 100)} AS reviews_per_reviewer,
  {pct('verified_purchase')} AS pct_verified, {pct('NOT verified_purchase')} AS pct_unverified,
  {pct('image_count > 0')} AS pct_with_images, {pct('has_text')} AS pct_with_text,
  {mean('helpful_vote', 100, 100)} AS avg_helpful_votes, {TEXT} AS avg_text_length,
  {', '.join(f"{pct(f'rating = {s}')} AS pct_{s}star" for s in range(1, 6))},
  {pct('rating IN (1, 5)')} AS pct_extreme_ratings,
  {pct_of('rating = 5', 'NOT verified_purchase')} AS pct_5star_among_unverified,
  {pct_of('rating = 5', 'verified_purchase')} AS pct_5star_among_verified
FROM reviews GROUP BY source_category""")

NEG, POS = "rating <= 2", "rating >= 4"

table("review_sentiment", f"""
SELECT source_category, count(*) AS total_reviews, {STARS} AS avg_rating,
  floor(median(rating) * 10 + 0.5) / 10.0 AS median_rating,
  count(*) FILTER (WHERE {POS}) AS positive_count,
  count(*) FILTER (WHERE rating = 3) AS neutral_count,
  count(*) FILTER (WHERE {NEG}) AS negative_count,
  {pct(POS)} AS pct_positive, {pct('rating = 3')} AS pct_neutral, {pct(NEG)} AS pct_negative,
  {pct('has_text')} AS pct_with_text, {TEXT} AS avg_text_length,
  {mean('text_length', 10, 10, f'{NEG} AND has_text')} AS avg_text_length_negative,
  {mean('text_length', 10, 10, f'{POS} AND has_text')} AS avg_text_length_positive,
  {half_up(f"avg(text_length) FILTER (WHERE {NEG} AND has_text) / nullif(avg(text_length) FILTER (WHERE {POS} AND has_text), 0)", 100)}
    AS negative_verbosity_ratio,
  {mean('helpful_vote', 100, 100, NEG)} AS avg_helpful_negative,
  {mean('helpful_vote', 100, 100, POS)} AS avg_helpful_positive,
  {pct_of('image_count > 0', NEG)} AS pct_images_negative,
  {pct_of('image_count > 0', POS)} AS pct_images_positive
FROM reviews GROUP BY source_category""")

table("temporal_trends", f"""
SELECT source_category, review_year, review_month, count(*) AS review_count,
  {STARS} AS avg_rating, floor(median(rating) * 10 + 0.5) / 10.0 AS median_rating,
  {pct('verified_purchase')} AS pct_verified, {pct('image_count > 0')} AS pct_with_images,
  {mean('helpful_vote', 100, 100)} AS avg_helpful_votes, {TEXT} AS avg_text_length,
  count(*) FILTER (WHERE {NEG}) AS negative_reviews,
  count(*) FILTER (WHERE rating = 3) AS neutral_reviews,
  count(*) FILTER (WHERE {POS}) AS positive_reviews, {pct(NEG)} AS pct_negative
FROM reviews WHERE review_year BETWEEN 1995 AND 2025 GROUP BY ALL""")


def keywords(source: str, key: str, column: str) -> str:
    """Word counts: each text is split once, then meets the reviews that carry it."""
    from mercata.plans.gold_reviews import STOPWORDS

    stop = ", ".join(f"'{w}'" for w in STOPWORDS)
    return f"""
SELECT source_category, sentiment, word, {big('sum(n * m)')} AS word_count
FROM (SELECT source_category, {key} AS body,
        CASE WHEN {POS} THEN 'positive' WHEN {NEG} THEN 'negative' ELSE 'neutral' END AS sentiment,
        count(*) AS n
      FROM reviews GROUP BY ALL)
JOIN (SELECT body, word, count(*) AS m
      FROM (SELECT {key} AS body,
              unnest(string_split(regexp_replace(lower({column}), '[^a-z0-9 ]', ' ', 'g'), ' ')) AS word
            FROM (SELECT DISTINCT {key}, {column} FROM {source}))
      WHERE length(word) > 2 AND word NOT IN ({stop}) GROUP BY ALL) USING (body)
GROUP BY ALL HAVING sum(n * m) >= 50"""


table("review_keywords", keywords("(SELECT p_name AS title FROM part)", "title", "title"))
