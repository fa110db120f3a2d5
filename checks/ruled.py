"""Reports over model tables, checked on scores and clusters that a rule gives.

A fitted model cannot be stated in SQL, but what is reported about its scores can.  Here trust
scores, archetypes, success scores and attributions come from integer arithmetic on the features,
which both engines share, and go through the same functions as the models' own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import sql as S
from checks.catalog import SELLABLE, SUB, SUCCESS_SQL, TRUST_SQL, entry, once, prank, stored, top, trust_signals
from mercata.functions import exact as E
from mercata.functions.columns import TRUST_TIERS
from mercata.ml import anomalies, attributions, clusters, success
from mercata.operators import ranks
from mercata.plans import analysis as A
from mercata.plans import quality, serving
from mercata.session import scratch_path
from mercata.sources import tables

# ---- trust scores ---------------------------------------------------------------------
S.table("ruled_scores", f"""SELECT * EXCLUDE (tenths), tenths / 10.0 AS trust_score, tenths < 60 AS is_suspicious
  FROM (SELECT *, (review_count * 37 + CAST(round(pct_5star * 10) AS BIGINT) * 3
    + CAST(round(verified_rate * 1000) AS BIGINT)) % 1001 AS tenths FROM ({TRUST_SQL}))""")


def ruled_scores(m) -> DataFrame:
    def make():
        features = trust_signals(m)
        tenths = (
            F.col("review_count") * 37 + F.round(F.col("pct_5star") * 10).cast("long") * 3
            + F.round(F.col("verified_rate") * 1000).cast("long")
        ) % 1001
        return clusters.checkpointed(features.withColumn("_tenths", tenths).withColumns({
            "trust_score": F.col("_tenths") / 10.0, "is_suspicious": F.col("_tenths") < 60,
        }).drop("_tenths"))

    return once(m, "ruled_scores", make)


def with_ruled(m):
    m.__dict__.update(product_trust_scores=ruled_scores(m), product_clusters=ruled_clusters(m))
    return m


@entry("S12_ruled_scores", "SELECT * FROM ruled_scores")
def _(m):
    scores = ruled_scores(m)
    return tables.materialize(scores, scratch_path(scores.sparkSession, "scores"))


@entry("M9_ruled_trust_cutoff", "SELECT max(trust_score) AS trust_cutoff FROM ruled_scores WHERE is_suspicious")
def _(m):
    return anomalies.trust_cutoff(ruled_scores(m))


CATEGORY = """SELECT source_category, count(*) AS total, count(*) FILTER (WHERE is_suspicious) AS anomalies,
  floor(sum(CAST(round(trust_score * 10) AS BIGINT)) / count(trust_score) / 10 * 10000 + 0.5) / 10000.0 AS avg_trust,
  floor(count(*) FILTER (WHERE is_suspicious) * 1000 / count(*) + 0.5) / 10.0 AS anomaly_rate
  FROM ruled_scores GROUP BY source_category"""


@entry("N35_ruled_anomaly_by_category", top(CATEGORY, "anomaly_rate", 20, "source_category"))
def _(m):
    return A.anomaly_by_category(ruled_scores(m))


FEATURE_MEANS = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, (SELECT avg({f}) FROM worst) AS worst, (SELECT avg({f}) FROM normal) AS normal"
    for f in A.TRUST_FEATURES
)
WORST = top("SELECT * FROM ruled_scores WHERE is_suspicious", "trust_score", 20, "parent_asin", "source_category", asc=True)


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Means of doubles agree between engines to some digits only."""
    return df.withColumns({c: E.half_up(c, 10**6) for c in cols})


@entry(
    "N36_ruled_suspicious_deviation",
    "SELECT feature, floor(worst * 1e6 + 0.5) / 1e6 AS worst, floor(normal * 1e6 + 0.5) / 1e6 AS normal, "
    f"floor((worst / nullif(normal, 0) - 1) * 100 * 1e6 + 0.5) / 1e6 AS deviation_pct FROM ({FEATURE_MEANS})",
    worst=WORST, normal="SELECT * FROM ruled_scores WHERE NOT is_suspicious",
)
def _(m):
    return _rounded(A.suspicious_deviation(ruled_scores(m), A.TRUST_FEATURES), "worst", "normal", "deviation_pct")


def groups(where: str = "TRUE") -> str:
    means = ", ".join(
        f"floor(avg({c}) * {by} * 1e6 + 0.5) / 1e6 AS {name}" for name, (c, by) in serving.PROFILE.items()
    )
    return f"""SELECT CASE WHEN is_suspicious THEN 'Suspicious' ELSE 'Normal' END AS group_label, count(*) AS products,
      {means} FROM ruled_scores WHERE {where} GROUP BY ALL"""


@entry("M11_ruled_compare_groups", groups())
def _(m):
    return _rounded(serving.compare_groups(ruled_scores(m)), *serving.PROFILE)


@entry("Q12_ruled_trust_profiles", groups("source_category = 'PROMO'"))
def _(m):
    return _rounded(serving.trust_profiles(with_ruled(m), "PROMO"), *serving.PROFILE)


@entry("Q12_ruled_trust_summary", """SELECT count(*) AS total, count(*) FILTER (WHERE is_suspicious) AS suspicious_count,
  floor(count(*) FILTER (WHERE is_suspicious) * 1000 / greatest(count(*), 1) + 0.5) / 10.0 AS pct_suspicious,
  floor(avg(trust_score) * 1e6 + 0.5) / 1e6 AS avg_trust,
  floor(avg(trust_score) FILTER (WHERE is_suspicious) * 1e6 + 0.5) / 1e6 AS avg_trust_suspicious,
  floor(avg(trust_score) FILTER (WHERE NOT is_suspicious) * 1e6 + 0.5) / 1e6 AS avg_trust_normal FROM ruled_scores""")
def _(m):
    return _rounded(serving.trust_summary(with_ruled(m)), "avg_trust", "avg_trust_suspicious", "avg_trust_normal")


@entry("Q12_ruled_trust_products", top(
    "SELECT * FROM ruled_scores WHERE is_suspicious", "trust_score", 50, "parent_asin", "source_category", asc=True))
def _(m):
    return serving.trust_products(with_ruled(m))


@entry("N37_P22_ruled_trust_tiers", "SELECT trust_tier, count(*) AS products FROM (SELECT CASE "
       + " ".join(f"WHEN trust_score <= {upper} THEN '{name}'" for upper, name in TRUST_TIERS)
       + " END AS trust_tier FROM ruled_scores) GROUP BY trust_tier")
def _(m):
    return A.trust_tiers(ruled_scores(m))


@entry("D6_ruled_check_rate", """SELECT 'rate of is_suspicious' AS "check", r > 2 AND r < 10 AS passed,
  CAST(round(r, 4) AS VARCHAR) AS detail FROM (SELECT count(*) FILTER (WHERE is_suspicious) * 100.0 / count(*) AS r FROM ruled_scores)""")
def _(m):
    return quality.check_rate(ruled_scores(m), "is_suspicious", 2, 10)


# ---- archetypes -----------------------------------------------------------------------
NAMES = [n for n, _ in clusters.ARCHETYPES]
S.table("ruled_clusters", f"""SELECT *, ['{"', '".join(NAMES)}'][cluster + 1] AS cluster_name
  FROM (SELECT asin, subcategory, price_cents, rating_tenths, review_count, bought_last_month, revenue_cents, title_length,
      rating_tenths / 10.0 AS rating, is_best_seller::INTEGER AS is_best_seller, {prank('price_cents', 'price_rank')},
      {prank('bought_last_month', 'sales_rank')}, {prank('review_count', 'reviews_rank')},
      {prank('title_length', 'title_length_rank')},
      CAST((review_count * 3 + bought_last_month + title_length) % 5 AS INTEGER) AS cluster FROM {SELLABLE})""")


def ruled_clusters(m) -> DataFrame:
    def make():
        number = (F.col("review_count") * 3 + F.col("bought_last_month") + F.col("title_length")) % 5
        named = F.element_at(F.array(*map(F.lit, NAMES)), F.col("cluster") + 1)
        features = clusters.cluster_features(stored(m, "products"))
        return clusters.checkpointed(features.withColumn("cluster", number.cast("int")).withColumn("cluster_name", named))

    return once(m, "ruled_clusters", make)


def _median(c: str, scale: int, per: int, name: str) -> str:
    return f"floor(quantile_cont({c}, 0.5) * {scale} + 0.5) / {scale}.0 / {per}.0 AS {name}"


@entry("M3_A17_ruled_archetype_profiles", f"""SELECT cluster_name, count(*) AS products,
  sum(revenue_cents) / 100.0 AS total_revenue, {S.half_up('avg(revenue_cents) / 100', 100)} AS avg_revenue,
  {S.half_up('avg(price_cents) / 100', 100)} AS avg_price, {S.half_up('avg(bought_last_month)', 100)} AS avg_sales,
  {S.half_up('avg(rating_tenths) / 10', 100)} AS avg_rating, {S.half_up('avg(review_count)', 100)} AS avg_reviews,
  {S.half_up('avg(is_best_seller) * 100', 10)} AS pct_bestseller,
  {S.half_up('avg(price_rank)', 1000)} AS price_rank, {S.half_up('avg(sales_rank)', 1000)} AS sales_rank,
  {S.half_up('avg(reviews_rank)', 1000)} AS reviews_rank, {S.half_up('avg(title_length_rank)', 1000)} AS title_length_rank,
  {_median('revenue_cents', 1, 100, 'median_revenue')}, {_median('price_cents', 1, 100, 'median_price')},
  {_median('bought_last_month', 10, 1, 'median_sales')}, {_median('review_count', 10, 1, 'median_reviews')}
  FROM ruled_clusters GROUP BY cluster_name""")
def _(m):
    return clusters.archetype_profiles(ruled_clusters(m))


@entry("N40_A18_ruled_archetype_mix", """SELECT subcategory, cluster_name, n, floor(n * 100.0 / total * 10 + 0.5) / 10.0 AS pct
  FROM (SELECT subcategory, cluster_name, count(*) AS n, sum(count(*)) OVER (PARTITION BY subcategory) AS total
    FROM ruled_clusters GROUP BY subcategory, cluster_name)
  WHERE subcategory IN (SELECT subcategory FROM ruled_clusters GROUP BY subcategory ORDER BY count(*) DESC, subcategory LIMIT 20)""")
def _(m):
    return clusters.archetype_mix(ruled_clusters(m))


@entry("N41_ruled_cluster_radar", "SELECT cluster_name, " + ", ".join(
    f"floor((x_{f} - min(x_{f}) OVER ()) / nullif(max(x_{f}) OVER () - min(x_{f}) OVER (), 0) * 1e6 + 0.5) / 1e6 AS {f}"
    for f in clusters.FEATURES) + " FROM (SELECT cluster_name, "
    + ", ".join(f"avg({f}) AS x_{f}" for f in clusters.FEATURES) + " FROM ruled_clusters GROUP BY cluster_name)")
def _(m):
    return _rounded(clusters.cluster_radar(ruled_clusters(m)), *clusters.FEATURES)


MIX = f"""SELECT cluster_name, count(*) AS product_count, {S.half_up('avg(price_rank)', 10**6)} AS avg_price_rank,
  {S.half_up('avg(sales_rank)', 10**6)} AS avg_sales_rank, {S.half_up('avg(reviews_rank)', 10**6)} AS avg_reviews_rank
  FROM ruled_clusters WHERE subcategory = '{SUB}' GROUP BY cluster_name"""


@entry("Q5_ruled_archetype_mix_of", MIX)
def _(m):
    return _rounded(serving.archetype_mix_of(with_ruled(m), SUB), "avg_price_rank", "avg_sales_rank", "avg_reviews_rank")


@entry("Q5_A14_ruled_archetype_ranks_long", " UNION ALL ".join(
    f"SELECT cluster_name, '{c}' AS metric, {c} AS avg_rank FROM ({MIX})"
    for c in ("avg_price_rank", "avg_sales_rank", "avg_reviews_rank")))
def _(m):
    return _rounded(serving.archetype_ranks_long(with_ruled(m), SUB), "avg_rank")


@entry("Q8_ruled_health_archetype", """SELECT asin, subcategory, own_archetype, cluster_name, products
  FROM (SELECT asin, subcategory, cluster_name AS own_archetype FROM ruled_clusters WHERE asin = '18')
  JOIN (SELECT subcategory, cluster_name, count(*) AS products FROM ruled_clusters GROUP BY ALL) USING (subcategory)""")
def _(m):
    return serving.health_archetype(with_ruled(m), "18")


# ---- success scores and attributions -----------------------------------------------------
S.table("success_listing", SUCCESS_SQL)
S.table("ruled_predictions", """SELECT * EXCLUDE (number), number / 1024.0 AS score, (number >= 512)::INTEGER AS predicted
  FROM (SELECT *, (price_cents * 7 + CAST(review_count AS BIGINT) * 13 + is_success * 300) % 1024 AS number
    FROM (SELECT *, CAST(round(price * 100) AS BIGINT) AS price_cents FROM success_listing))""")


def ruled_predictions(m) -> DataFrame:
    features = once(m, "success_features", lambda: clusters.checkpointed(success.success_features(stored(m, "products"))))
    number = (
        F.round(F.col("price") * 100).cast("long") * 7 + F.col("review_count").cast("long") * 13 + F.col("is_success") * 300
    ) % 1024
    score = number / 1024.0
    return features.withColumns({"score": score, "rawPrediction": score, "predicted": (number >= 512).cast("int")})


@entry(
    "M5e_ruled_evaluation", """SELECT metric, floor(value * 1e6 + 0.5) / 1e6 AS value FROM (
    SELECT 'accuracy' AS metric, fit / n AS value FROM tallied UNION ALL SELECT 'f1', 2 * tp / (2 * tp + n - fit) FROM tallied
    UNION ALL SELECT 'auc', (places - pos * (pos + 1) / 2) / (pos * neg) FROM tallied)""",
    ranked="SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS place FROM ruled_predictions",
    tallied="""SELECT count(*) FILTER (WHERE is_success = 1) AS pos, count(*) FILTER (WHERE is_success = 0) AS neg,
    count(*) FILTER (WHERE predicted = is_success) AS fit, count(*) AS n,
    count(*) FILTER (WHERE predicted = 1 AND is_success = 1) AS tp, sum(place) FILTER (WHERE is_success = 1) AS places FROM ranked""",
)
def _(m):
    return _rounded(success.evaluate_success(ruled_predictions(m)), "value")


@entry("M5e_ruled_confusion_matrix",
       "SELECT is_success AS actual, predicted, count(*) AS n FROM ruled_predictions GROUP BY is_success, predicted")
def _(m):
    return success.confusion_matrix(ruled_predictions(m))


@entry("M5e_ruled_roc_curve", """SELECT score AS threshold, sum(neg) OVER (ORDER BY score DESC) / sum(neg) OVER () AS fpr,
  sum(pos) OVER (ORDER BY score DESC) / sum(pos) OVER () AS tpr FROM (
    SELECT score, count(*) FILTER (WHERE is_success = 1) AS pos, count(*) FILTER (WHERE is_success = 0) AS neg
    FROM ruled_predictions GROUP BY score)""")
def _(m):
    return success.roc_curve(ruled_predictions(m))


def ruled_attributions(m) -> DataFrame:
    """Attributions in 64ths, whose sums are exact in any order."""
    base = ruled_predictions(m)
    share = lambda i: (F.round(F.col("price") * 100).cast("long") * (i + 1) + F.col("title_length").cast("long")) % 129 - 64
    return base.withColumns({f"shap_{f}": share(i) / 64.0 for i, f in enumerate(success.FEATURES)}).withColumns(
        {"base_value": F.lit(0.5), "margin": F.col("score"), "probability": F.col("score")}
    )


def _shap(i: int) -> str:
    return f"((price_cents * {i + 1} + CAST(title_length AS BIGINT)) % 129 - 64) / 64.0"


@entry("M7_ruled_shap_summary", " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, avg(abs(s)) AS mean_abs_shap, coalesce(avg(s) FILTER (WHERE v > md), 0) AS avg_shap_high,
      coalesce(avg(s) FILTER (WHERE v <= md), 0) AS avg_shap_low,
      coalesce(avg(s) FILTER (WHERE v > md), 0) - coalesce(avg(s) FILTER (WHERE v <= md), 0) AS direction
    FROM (SELECT {f} AS v, {_shap(success.FEATURES.index(f))} AS s, (SELECT quantile_cont({f}, 0.5) FROM ruled_predictions) AS md
      FROM ruled_predictions)""" for f in success.FEATURES))
def _(m):
    return attributions.shap_summary(ruled_attributions(m))


@entry("M6_ruled_waterfall", " UNION ALL ".join(
    f"""SELECT asin, CAST(0.5 AS DOUBLE) AS base_value, score AS margin, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, {_shap(success.FEATURES.index(f))} AS shap
    FROM (SELECT * FROM ruled_predictions WHERE is_success = 1 ORDER BY score DESC, asin LIMIT 3)""" for f in success.FEATURES))
def _(m):
    return attributions.waterfall(ruled_attributions(m), 3)


@entry("W1_percent_rank_of_medians", f"""SELECT quantile_cont(price_rank, 0.5) AS price_rank, quantile_cont(sales_rank, 0.5) AS sales_rank
  FROM ruled_clusters""")
def _(m):
    return ranks.medians(ruled_clusters(m), {"price_rank": "price_rank", "sales_rank": "sales_rank"})
