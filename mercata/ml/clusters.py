"""Product archetypes: category-relative features, K-Means, names and projection."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.functions.exact import half_up
from mercata.ml import kmeans
from mercata.operators import ranks as R
from mercata.operators.relational import crosstab_pct, rows_of_top_groups
from mercata.session import shared_dir, shuffles_dropped

FEATURES = ["price_rank", "sales_rank", "reviews_rank", "rating", "is_best_seller", "title_length_rank"]

# Archetypes in the order they claim a cluster, with the feature
# whose centroid must be highest among the clusters still free.
ARCHETYPES = [
    ("Best Seller Elite", "is_best_seller"),
    ("Review-Rich Veterans", "reviews_rank"),
    ("Silent Volume Movers", "sales_rank"),
    ("Quiet Quality", "rating"),
    ("Struggling Listers", None),
]


def sellable(products: DataFrame) -> DataFrame:
    """Listings that sell, have a price and are rated."""
    return products.where("bought_last_month > 0 and price_cents > 0 and rating_tenths > 0")


def cluster_features(products: DataFrame) -> DataFrame:
    """Sellable listings with their ranks within the subcategory; rows with a gap are dropped."""
    base = sellable(products).select(
        "asin", "subcategory", "price_cents", "rating_tenths", "review_count", "bought_last_month",
        "revenue_cents", "title_length",
        (F.col("rating_tenths") / 10.0).alias("rating"),
        F.col("is_best_seller").cast("int").alias("is_best_seller"),
    )
    ranked = R.percent_rank_in(base, ["subcategory"], {
        "price_rank": "price_cents", "sales_rank": "bought_last_month",
        "reviews_rank": "review_count", "title_length_rank": "title_length",
    })
    return ranked.na.drop(subset=FEATURES)


def scaler(features: list[str]) -> Pipeline:
    """Assemble the features and scale them to zero mean and unit deviation."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="raw_vector"),
        StandardScaler(inputCol="raw_vector", outputCol="vector", withMean=True, withStd=True),
    ])


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder before an iterative job."""
    shared_dir(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        return df.checkpoint()


def choose_k(
    features: DataFrame, ks=range(2, 13), silhouette_up_to: int = 10, seed: int = 42, sample: int = kmeans.SILHOUETTE_SAMPLE
) -> DataFrame:
    """Training cost and silhouette per k, of one model on all rows.

    All models share the passes over the rows.  Silhouettes are by Euclidean distance, of up to
    ``sample`` rows against each other; of all rows only sums per cluster reach the driver.
    """
    ks = list(ks)
    _, points = kmeans.points_of(features, "asin", FEATURES)
    models = kmeans.fit(points, ks, seed, max_iter=300)
    judged = [m for k, (m, _) in zip(ks, models) if k <= silhouette_up_to]
    scores = iter(kmeans.silhouettes(points, judged, seed, sample))
    rows = [(k, cost, next(scores) if k <= silhouette_up_to else None) for k, (_, cost) in zip(ks, models)]
    return features.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def name_clusters(centers: list, features: list[str] = FEATURES) -> dict[int, str]:
    """Archetype names from the centroids, since cluster numbers carry no meaning."""
    free = dict(enumerate(centers))
    names = {}
    for label, feature in ARCHETYPES:
        if not free:
            break
        if feature is None:
            best = min(free)
        else:
            at = features.index(feature)
            best = max(free, key=lambda c: (free[c][at], -c))
        names[best] = label
        del free[best]
    for i, c in enumerate(sorted(free), 1):
        names[c] = f"Archetype {len(ARCHETYPES) + i}"
    return names


def fit_archetypes(features: DataFrame, k: int = 5, seed: int = 42, max_iter: int = 500) -> PipelineModel:
    """One answer for one set of listings, in whatever order and partitions they come."""
    scale, points = kmeans.points_of(features, "asin", FEATURES)
    centres, _ = kmeans.fit(points, [k], seed, max_iter)[0]
    return PipelineModel([kmeans.CentresModel(features=FEATURES, scale=[list(s) for s in scale], centres=centres.tolist())])


def assign_archetypes(features: DataFrame, k: int = 5, model: PipelineModel | None = None) -> DataFrame:
    """Every listing with its cluster and the cluster's name."""
    if model is None:
        features = checkpointed(features)
        model = fit_archetypes(features, k)
    names = name_clusters([c.tolist() for c in model.stages[-1].clusterCenters()])
    label = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return model.transform(features).withColumn("cluster_name", F.element_at(label, F.col("cluster")))


def centre_table(model: PipelineModel) -> DataFrame:
    """The fitted centres as rows: (cluster, feature, mean, deviation, centre), the centre in deviations from the mean."""
    stage = model.stages[-1]
    features, scale = stage.getOrDefault(stage.features), stage.getOrDefault(stage.scale)
    rows = [
        (i, f, float(mean), float(spread), float(x))
        for i, c in enumerate(stage.clusterCenters()) for f, (mean, spread), x in zip(features, scale, c)
    ]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "cluster int, feature string, mean double, deviation double, centre double")


def centre_distances(assigned: DataFrame, centres: DataFrame) -> DataFrame:
    """(asin, cluster, other, distance): squared distance of every listing to every centre, by the table of centres."""
    long = assigned.select("asin", "cluster", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in FEATURES
    ])).alias("x")).select("asin", "cluster", "x.*")
    gap = F.try_divide(F.col("value") - F.col("mean"), F.col("deviation"))
    gap = F.coalesce(gap, F.lit(0.0)) - F.col("centre")
    return long.join(centres.withColumnRenamed("cluster", "other"), "feature").groupBy("asin", "cluster", "other").agg(
        F.sum(gap * gap).alias("distance")
    )


def placement_check(assigned: DataFrame, centres: DataFrame, slack: float = 1e-5) -> DataFrame:
    """How many listings lie with their nearest centre: (listings, at_nearest).  ``slack`` covers the rounding of scaled
    features to whole units."""
    own = F.min(F.when(F.col("other") == F.col("cluster"), F.col("distance"))).alias("own")
    each = centre_distances(assigned, centres).groupBy("asin").agg(own, F.min("distance").alias("least"))
    return each.agg(
        F.count(F.lit(1)).alias("listings"), F.count_if(F.col("own") <= F.col("least") + slack).alias("at_nearest")
    )


def rest_check(assigned: DataFrame, centres: DataFrame) -> DataFrame:
    """(archetypes, at_rest): the centres, and those that lie at the mean of their listings within the tolerance of the fit."""
    means = assigned.groupBy("cluster").agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in FEATURES])
    means = means.unpivot("cluster", FEATURES, "feature", "value")
    gap = F.coalesce(F.try_divide(F.col("value") - F.col("mean"), F.col("deviation")), F.lit(0.0)) - F.col("centre")
    each = centres.join(means, ["cluster", "feature"], "left").groupBy("cluster").agg(F.sum(gap * gap).alias("moved"))
    return each.agg(
        F.count(F.lit(1)).alias("archetypes"), F.count_if(F.col("moved") <= 2 * kmeans.TOLERANCE).alias("at_rest")
    )


def product_clusters(products: DataFrame, k: int = 5) -> DataFrame:
    assigned = assign_archetypes(cluster_features(products), k)
    return assigned.select(
        "asin", "subcategory", "cluster", "cluster_name", "price_rank", "sales_rank", "reviews_rank"
    )


# ---- profiles -----------------------------------------------------------------

def archetype_profiles(assigned: DataFrame) -> DataFrame:
    """Size, revenue and typical values per archetype."""
    agg = assigned.groupBy("cluster_name").agg(
        F.count(F.lit(1)).alias("products"),
        (F.sum("revenue_cents") / 100.0).alias("total_revenue"),
        half_up(F.avg("revenue_cents") / 100, 100).alias("avg_revenue"),
        half_up(F.avg("price_cents") / 100, 100).alias("avg_price"),
        half_up(F.avg("bought_last_month"), 100).alias("avg_sales"),
        half_up(F.avg("rating_tenths") / 10, 100).alias("avg_rating"),
        half_up(F.avg("review_count"), 100).alias("avg_reviews"),
        half_up(F.avg("is_best_seller") * 100, 10).alias("pct_bestseller"),
        *[half_up(F.avg(f"{r}_rank"), 1000).alias(f"{r}_rank") for r in ("price", "sales", "reviews")],
        half_up(F.avg("title_length_rank"), 1000).alias("title_length_rank"),
    )
    return R.with_quantiles(agg, assigned, ["cluster_name"], {
        "median_revenue": ("revenue_cents", 0.5, 1, 100), "median_price": ("price_cents", 0.5, 1, 100),
        "median_sales": ("bought_last_month", 0.5, 10, 1), "median_reviews": ("review_count", 0.5, 10, 1),
    })


def cluster_radar(assigned: DataFrame) -> DataFrame:
    """Mean features per archetype, scaled to 0..1 over the archetypes."""
    from mercata.operators.relational import with_scalars

    means = assigned.groupBy("cluster_name").agg(*[F.avg(f).alias(f) for f in FEATURES])
    bounds = {}
    for f in FEATURES:
        bounds[f"_lo_{f}"], bounds[f"_hi_{f}"] = F.min(f), F.max(f)
    wide = with_scalars(means, **bounds)
    return wide.select("cluster_name", *[
        F.try_divide(F.col(f) - F.col(f"_lo_{f}"), F.col(f"_hi_{f}") - F.col(f"_lo_{f}")).alias(f)
        for f in FEATURES
    ])


def archetype_mix(clusters: DataFrame, k: int = 20) -> DataFrame:
    """Share of each archetype in the k largest subcategories."""
    top = rows_of_top_groups(clusters, "subcategory", F.count(F.lit(1)), k)
    return crosstab_pct(top, "subcategory", "cluster_name")


# ---- projection ---------------------------------------------------------------

def fit_projection(df: DataFrame, features: list[str], n: int = 2) -> PipelineModel:
    return Pipeline(stages=[
        *scaler(features).getStages(), PCA(k=n, inputCol="vector", outputCol="projected"),
    ]).fit(df)


def directions(model: PipelineModel) -> list[float]:
    """1 or -1 for each component, so that its largest weight (of equal ones the first) is positive: a component's sign
    carries no meaning, and the solver's may differ between runs."""
    weights = model.stages[-1].pc.toArray()
    return [1.0 if w[np.abs(w).round(9).argmax()] >= 0 else -1.0 for w in weights.T]


def project(df: DataFrame, features: list[str], n: int = 2, model: PipelineModel | None = None) -> DataFrame:
    """Rows with their first principal components."""
    model = model or fit_projection(df, features, n)
    out = model.transform(df).withColumn("_p", vector_to_array("projected"))
    return out.withColumns({f"pc{i + 1}": F.get("_p", F.lit(i)) * d for i, d in enumerate(directions(model))}).drop(
        "_p", "projected", "raw_vector", "vector"
    )


def loadings(df: DataFrame, features: list[str], n: int = 2, model: PipelineModel | None = None) -> DataFrame:
    """Weight of every feature in every component, with the variance each explains."""
    model = model or fit_projection(df, features, n)
    pca = model.stages[-1]
    matrix, variance = pca.pc.toArray() * np.array(directions(model)), pca.explainedVariance.toArray()
    rows = [
        (f"PC{j + 1}", f, round(float(matrix[i, j]), 3), float(variance[j]))
        for j in range(n) for i, f in enumerate(features)
    ]
    return df.sparkSession.createDataFrame(
        rows, "component string, feature string, loading double, explained_variance double"
    )
