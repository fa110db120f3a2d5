"""Proofs of fitted models' answers: what a model has written is worked out once more by other means, row by row.

SQL cannot fit the models, but it knows how many rows there are; each query counts the rows, over the whole
population, whose written answer agrees with the second reckoning.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from checks.catalog import (
    SELLABLE, TRUST_SQL, _archetypes, _assigned, _features, _success, _trust_signals, entry, once, raw_entry, trust_scores,
)
from mercata import roles
from mercata.ml import anomalies, attributions, clusters, models, success
from mercata.operators.relational import add_single_row
from mercata.plans import analysis as A
from mercata.plans import serving
from mercata.session import scratch_path
from mercata.sources import tables

LISTINGS = f"SELECT count(*) AS listings, count(*) AS agreeing FROM {SELLABLE}"


def agreeing(df: DataFrame, cond, rows: str = "listings") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(rows), F.count_if(cond).alias("agreeing"))


def near(a, b, slack: float = 1e-9):
    return F.abs(F.col(a) - F.col(b)) <= slack


# ---- success model -----------------------------------------------------------------------

def _leaf_table(m) -> DataFrame:
    """The model's leaves as rows: (leaf, value, feature, above, up_to), one for each bound on the way to a leaf."""
    def make():
        spark = m.products.sparkSession
        leaves, _ = attributions.tree_leaves(_success(m)[1], spark)
        rows = [
            (i, float(value), f, float(above), float(up_to))
            for i, (value, path) in enumerate(leaves) for f, (_, above, up_to) in (path or {-1: (1.0, -np.inf, np.inf)}).items()
        ]
        return clusters.checkpointed(spark.createDataFrame(rows, "leaf int, value double, feature int, above double, up_to double"))

    return once(m, "leaf_table", make)


def _explained_all(m) -> DataFrame:
    split, model = _success(m)
    return once(m, "explained_all", lambda: clusters.checkpointed(attributions.explain(model, split)))


@entry("M5_margins_by_joins", LISTINGS)
def _(m):
    """Each listing joined with the written leaves it falls into: their values add up to the model's margin."""
    split, model = _success(m)
    met = attributions.join_leaves(split.select("asin", *success.FEATURES), _leaf_table(m), success.FEATURES)
    margins = met.groupBy("asin").agg(F.sum("value").alias("joined"))
    scored = success.predict(model, split).select("asin", "score")
    return agreeing(margins.join(scored, "asin").withColumn("expected", 1 / (1 + F.exp(-2 * F.col("joined")))), near("score", "expected"))


@entry("M5_loss_curve", "SELECT TRUE AS kept_up_to_the_best, TRUE AS patience_held")
def _(m):
    """Of the rounds tried in the one fit, those up to the smallest loss are kept, and at most 20 more were tried."""
    curve = success.loss_curve(m.products.sparkSession, _success(m)[1])
    best = F.min_by("round", F.struct("loss", "round"))
    return curve.agg(best.alias("best"), F.count_if("kept").alias("kept"), F.max("round").alias("tried")).select(
        (F.col("best") == F.col("kept")).alias("kept_up_to_the_best"), (F.col("tried") <= F.col("best") + 20).alias("patience_held")
    )


@entry("M6_attributions_add_up", LISTINGS)
def _(m):
    """Attributions and base value against the margin, and the margin against the model's own score, for every listing."""
    explained = _explained_all(m)
    total = reduce(lambda a, b: a + b, [F.col(f"shap_{f}") for f in success.FEATURES], F.col("base_value"))
    scored = success.predict(_success(m)[1], _success(m)[0]).select("asin", "score")
    both = explained.withColumn("total", total).join(scored, "asin")
    return agreeing(both, near("total", "margin") & near("probability", "score"))


@entry("M7_summary_of_written_attributions", "SELECT CAST(14 AS BIGINT) AS features, CAST(14 AS BIGINT) AS agreeing")
def _(m):
    """Means per feature by unpivoting the written attributions, against the summary."""
    explained = _explained_all(m)
    shap = explained.select(*[F.col(f"shap_{f}").alias(f) for f in success.FEATURES])
    plain = shap.unpivot([], success.FEATURES, "feature", "v").groupBy("feature").agg(F.avg(F.abs("v")).alias("expected"))
    return agreeing(attributions.shap_summary(explained).join(plain, "feature"), near("mean_abs_shap", "expected"), "features")


@entry("M5e_scores_recounted", f"SELECT count(*) AS listings, TRUE AS accuracy, TRUE AS f1, TRUE AS auc FROM {SELLABLE}")
def _(m):
    """Accuracy, F1 and area under the curve of the written scores of all listings, by counts and by ranks with mean places of ties."""
    split, model = _success(m)
    written = once(m, "written_scores", lambda: clusters.checkpointed(success.predict(model, split).select(
        "asin", "is_success", "predicted", "score", "rawPrediction")))
    metrics = success.evaluate_success(written).groupBy().pivot("metric", ["accuracy", "f1", "auc"]).agg(F.first("value"))
    counts = written.groupBy("score").agg(F.count_if(F.expr("is_success = 1")).alias("p"), F.count_if(F.expr("is_success = 0")).alias("n"))
    below = Window.orderBy("score").rowsBetween(Window.unboundedPreceding, -1)  # of a small test table
    pairs = counts.withColumn("won", F.col("p") * (F.coalesce(F.sum("n").over(below), F.lit(0)) + F.col("n") / 2))
    area = pairs.agg((F.sum("won") / (F.sum("p") * F.sum("n"))).alias("area"))
    tally = written.agg(
        F.count(F.lit(1)).alias("listings"), F.avg((F.col("predicted") == F.col("is_success")).cast("double")).alias("right"),
        (2 * F.count_if(F.expr("predicted = 1 AND is_success = 1")) / (F.count_if(F.expr("predicted = 1")) + F.count_if(F.expr("is_success = 1")))).alias("dice"),
    )
    return add_single_row(add_single_row(tally, area), metrics).select(
        "listings", near("accuracy", "right").alias("accuracy"), near("f1", "dice").alias("f1"), near("auc", "area").alias("auc")
    )


@entry("M5e_confusion_of_written_scores", f"SELECT count(*) AS listings, CAST(sum(s) AS BIGINT) AS successes FROM (SELECT (ntile(4) OVER (PARTITION BY subcategory "
       f"ORDER BY revenue_cents, md5(asin), asin) = 4)::INTEGER AS s FROM {SELLABLE})")
def _(m):
    """The cells of the matrix over all listings add up to the listings and, of the actual successes, to these."""
    split, model = _success(m)
    cells = success.confusion_matrix(success.predict(model, split))
    return cells.agg(F.sum("n").alias("listings"), F.sum(F.when(F.col("actual") == 1, F.col("n"))).alias("successes"))


@entry("M5e_curve_ends", "SELECT TRUE AS rises, CAST(1 AS DOUBLE) AS last_fpr, CAST(1 AS DOUBLE) AS last_tpr")
def _(m):
    """Along the thresholds of the fitted scores both rates rise, to 1."""
    split, model = _success(m)
    return success.curve_ends(success.roc_curve(success.predict(model, split)))


# ---- isolation forest --------------------------------------------------------------------

PRODUCTS = f"SELECT count(*) AS products, count(*) AS agreeing FROM ({TRUST_SQL})"


@entry("M9_paths_by_joins", PRODUCTS)
def _(m):
    """Every product walks down every tree by joins with the written nodes; the mean of the leaves' paths gives its score."""
    features = _trust_signals(m)
    nodes = clusters.checkpointed(anomalies.fit_forest(features))
    scored = anomalies.raw_scores(features, nodes)
    trees = nodes.agg(F.count_distinct("tree").alias("trees"), F.max("rows").alias("seen"))
    x = F.array(*[F.col(f) for f in A.TRUST_FEATURES])
    roots = F.explode(F.sequence(F.lit(0), F.lit(nodes.agg(F.max("tree")).first()[0])))
    at = features.select("parent_asin", "source_category", x.alias("x"), roots.alias("tree")).withColumn("node", F.lit(0))
    table = F.broadcast(nodes)
    for _ in range(8):  # depth of a tree of 256 rows
        inner = at.join(table, ["tree", "node"])
        down = F.when(F.get("x", F.col("feature")) <= F.col("cut"), F.col("left")).otherwise(F.col("right"))
        at = inner.select("parent_asin", "source_category", "x", "tree", F.when(F.col("feature") < 0, F.col("node")).otherwise(down).alias("node"))
    ends = at.join(table, ["tree", "node"]).where("feature < 0").groupBy("parent_asin", "source_category").agg(
        F.avg("path").alias("depth"), F.count(F.lit(1)).alias("ends"))
    n = F.col("seen").cast("double")
    typical = 2 * (F.log(n - 1) + F.lit(float(np.euler_gamma))) - 2 * (n - 1) / n
    expected = -F.pow(F.lit(2.0), -F.col("depth") / typical) * anomalies.SCORE_UNIT
    both = add_single_row(scored.join(ends, ["parent_asin", "source_category"]), trees)
    fits = (F.abs(F.col("raw_score") - expected) <= 1) & (F.col("ends") == F.col("trees"))
    return agreeing(both, fits, "products")


@entry("M9_scores_and_flags", f"""SELECT count(*) AS products, TRUE AS in_range, TRUE AS flags_lie_below, TRUE AS share_flagged
  FROM ({TRUST_SQL})""")
def _(m):
    """Trust scores lie in 0 to 100, flagged products score no better than any other, and 5 % of the products are flagged."""
    flag, score = F.col("is_suspicious"), F.col("trust_score")
    return trust_scores(m).agg(
        F.count(F.lit(1)).alias("products"), ((F.min(score) >= 0) & (F.max(score) <= 100)).alias("in_range"),
        (F.max(F.when(flag, score)) <= F.min(F.when(~flag, score))).alias("flags_lie_below"),
        (F.abs(F.count_if(flag) - F.count(F.lit(1)) * 0.05) <= 1).alias("share_flagged"),
    )


# ---- archetypes, saving, reading ---------------------------------------------------------

@entry("M2_costs_fall", "SELECT 11 AS ks, 11 AS falling, 9 AS judged")
def _(m):
    """Costs fall with every further centre; silhouettes are there for k up to 10 and lie in -1 to 1."""
    order = Window.orderBy("k")  # eleven rows
    chosen = clusters.choose_k(_features(m)).withColumn("before", F.lag("inertia").over(order))
    falls = F.col("before").isNull() | (F.col("inertia") < F.col("before"))
    return chosen.agg(
        F.count(F.lit(1)).cast("int").alias("ks"), F.count_if(falls).cast("int").alias("falling"),
        F.count_if(F.abs("silhouette") <= 1).cast("int").alias("judged"),
    )


@entry("M2_inertia_of_the_archetypes", f"SELECT count(*) AS listings, TRUE AS same_cost FROM {SELLABLE}")
def _(m):
    """The cost the fit reports for five centres, against distances by joins with the table of centres."""
    reported = clusters.choose_k(_features(m), [5], 0).first().inertia
    own = clusters.centre_distances(_assigned(m), clusters.centre_table(_archetypes(m))).where("cluster = other")
    return own.agg(
        F.count(F.lit(1)).alias("listings"), (F.abs(F.sum("distance") - F.lit(reported)) <= F.lit(reported) * 1e-3).alias("same_cost")
    )


@entry("M3_clusters_of_listings", f"SELECT asin, subcategory, TRUE AS named FROM {SELLABLE}")
def _(m):
    """Every sellable listing has a cluster, and the name that its cluster's centre has."""
    names = clusters.name_clusters([c.tolist() for c in _archetypes(m).stages[-1].clusterCenters()])
    label = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return m.product_clusters.select("asin", "subcategory", (F.element_at(label, F.col("cluster")) == F.col("cluster_name")).alias("named"))


@entry("M10_loaded_model_agrees", LISTINGS)
def _(m):
    """What the saved and loaded model says of every listing, against what the fitted one said."""
    spark = m.products.sparkSession
    path = scratch_path(spark, "archetypes")
    models.save(_archetypes(m), path, {"k": 5})
    model, _ = models.load(spark, path)
    again = clusters.assign_archetypes(_features(m), model=model).select("asin", F.col("cluster_name").alias("loaded"))
    return agreeing(_assigned(m).join(again, "asin"), F.col("cluster_name") == F.col("loaded"))


@raw_entry("S13_bench_read_rows", "SELECT count(*) AS rows, TRUE AS timed FROM lineitem")
def _(spark, sf_dir):
    seen = tables.bench_read(roles.table(spark, sf_dir, "lineitem"))
    return seen.select("rows", ((F.col("seconds") > 0) & (F.col("rows_per_second") > 0)).alias("timed"))


@entry("S12_written_scores", f"SELECT parent_asin, source_category, review_count, pct_5star, pct_1star FROM ({TRUST_SQL})")
def _(m):
    """The persisted scores, read back: the products and the signals they were scored by."""
    scores = trust_scores(m)
    return tables.materialize(scores, scratch_path(scores.sparkSession, "scores")).select(
        "parent_asin", "source_category", "review_count", "pct_5star", "pct_1star"
    )


@entry("Q9_diagnosis_agrees", f"""SELECT asin, subcategory, TRUE AS adds_up, TRUE AS banded, TRUE AS split FROM products
  WHERE asin IN ('18', '7', '102')""")
def _(m):
    """Probability, band and factors of a diagnosis follow from the margin and from each other."""
    model = _success(m)[1]
    found = serving.health_diagnosis(m, model, ["18", "7", "102"])
    p = F.col("probability")
    band = F.when(p >= 0.6, "strong").when(p >= 0.4, "middling").otherwise("weak")
    return found.select(
        "asin", "subcategory", (F.abs(p - 1 / (1 + F.exp(-2 * F.col("margin")))) < 1e-9).alias("adds_up"),
        (F.col("band") == band).alias("banded"),
        ((F.size(F.array_intersect("helping", "hurting")) == 0) & (F.size("helping") <= 3) & (F.size("hurting") <= 3)).alias("split"),
    )
