"""Which listings reach the top revenue quarter of their subcategory, and why."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mercata.ml import boosting
from mercata.ml.clusters import checkpointed, sellable
from mercata.operators import ranks as R

# What a shopper can see on the listing; nothing derived from sales.
FEATURES = [
    "price", "rating", "review_count", "title_length", "is_best_seller", "has_brand", "has_features",
    "has_description", "has_store", "discount_pct", "is_matched", "price_rank", "reviews_rank",
    "title_length_rank",
]
LABEL = "is_success"
ROC_CELLS = 1 << 20    # cells of neighbouring scores that are summed together


def feature_columns(ranked: DataFrame, *keep: str) -> DataFrame:
    """The model's inputs as doubles, missing ones as zero."""
    values = {
        "price": F.col("price_cents") / 100.0,
        "rating": F.col("rating_tenths") / 10.0,
        "discount_pct": F.col("discount_tenths") / 10.0,
    }
    return ranked.select(
        "asin", "subcategory", *keep,
        *[F.coalesce(values.get(f, F.col(f)).cast("double"), F.lit(0.0)).alias(f) for f in FEATURES],
    )


def success_features(products: DataFrame, population=sellable) -> DataFrame:
    """Inputs and label of every listing in the population.

    Ranks and quarters are taken within the population's subcategories, over the few columns
    the model needs.
    """
    base = population(products).select(
        "asin", "subcategory", "revenue_cents", "price_cents", "rating_tenths", "discount_tenths",
        *[f for f in FEATURES if f in products.columns and f not in ("price", "rating", "discount_pct")],
    )
    ranked = R.ntile_in(base, ["subcategory"], "revenue_cents", 4, "asin", "revenue_quartile")
    ranked = R.percent_rank_in(ranked, ["subcategory"], {
        "price_rank": "price_cents", "reviews_rank": "review_count", "title_length_rank": "title_length",
    })
    labelled = ranked.withColumn(LABEL, (F.col("revenue_quartile") == 4).cast("int"))
    return feature_columns(labelled, "revenue_cents", "revenue_quartile", LABEL)


def stratified_split(df: DataFrame, test: float = 0.2, validation: float = 0.1, seed: int = 42) -> DataFrame:
    """Add ``fold``: train, validation or test.

    Every row is drawn by the hash of its id, label by label alike, so the shares in each label are
    met within sampling error, nothing is shuffled, and a rerun splits the same way.
    """
    draw = F.shiftrightunsigned(F.xxhash64("asin", F.lit(seed)), 11).cast("double") / F.lit(float(1 << 53))
    fold = F.when(draw < test, "test").when(draw < test + (1 - test) * validation, "validation").otherwise("train")
    return df.withColumn("fold", fold)


def rounds_to_keep(losses: list[float], patience: int) -> int | None:
    """Rounds up to the best one after which ``patience`` rounds bring no gain; None while
    the losses are too few to tell."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        if i - best >= patience:
            return best + 1
    return None


def train_success(
    split: DataFrame, max_iter: int = 300, max_depth: int = 6, step: float = 0.1, seed: int = 42, patience: int = 20
) -> PipelineModel:
    """Boosted trees on the train fold, stopped early on the validation fold, in one fit (:mod:`mercata.ml.boosting`).

    Boosting goes on until ``patience`` rounds bring no gain on the validation fold, and the rounds up to
    the best are kept.  Successes are weighted so both labels count the same.
    The validation fold is not the test fold, so the test scores stay honest.
    """
    used = split.where(F.col("fold") != "test")
    totals = used.where("fold = 'train'").agg(
        (F.count_if(F.col(LABEL) == 0) / F.greatest(F.count_if(F.col(LABEL) == 1), F.lit(1))).alias("_w")
    )
    from mercata.operators.relational import add_single_row

    weighted = add_single_row(used, totals).select(
        "asin", *FEATURES, F.col(LABEL).cast("double").alias("label"),
        F.when(F.col(LABEL) == 1, F.col("_w")).otherwise(1.0).cast("double").alias("weight"), (F.col("fold") == "train").alias("train"),
    )
    return PipelineModel([boosting.fit(weighted, FEATURES, "asin", max_iter, max_depth, step, seed, patience, rounds_to_keep)])


def loss_curve(spark, model: PipelineModel) -> DataFrame:
    """(round, loss, kept): mean loss on the validation fold after each round that was tried."""
    stage = model.stages[-1]
    rows = [(i + 1, float(x), i < stage.getNumTrees) for i, x in enumerate(stage.getOrDefault(stage.lossCurve))]
    return spark.createDataFrame(rows, "round int, loss double, kept boolean")


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("score", F.col("probability")).withColumn("predicted", F.col("prediction").cast("int"))


def evaluate_success(predicted: DataFrame) -> DataFrame:
    """Accuracy, F1 and area under the curve as (metric, value) rows."""
    right = F.col("predicted") == F.col(LABEL)
    tp = F.count_if((F.col("predicted") == 1) & (F.col(LABEL) == 1))
    wrong = F.count_if(~right)
    counts = predicted.agg(
        F.avg(right.cast("double")).alias("accuracy"), F.try_divide(2.0 * tp, 2 * tp + wrong).alias("f1")
    )
    auc = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol=LABEL, numBins=0).evaluate(predicted)
    return counts.withColumn("auc", F.lit(float(auc))).unpivot([], ["accuracy", "f1", "auc"], "metric", "value")


def confusion_matrix(predicted: DataFrame) -> DataFrame:
    return predicted.groupBy(F.col(LABEL).alias("actual"), "predicted").agg(F.count(F.lit(1)).alias("n"))


def roc_cell():
    return F.floor(F.col("threshold") * ROC_CELLS)


def roc_curve(predicted: DataFrame) -> DataFrame:
    """True and false positive rates at every distinct score.

    Scores are counted before they are shuffled and summed in two steps, inside cells of neighbouring
    scores and over the cells, so no task holds them all.  The counts are written, since each step reads them and
    the model would score all rows again for each."""
    per = checkpointed(predicted.groupBy(F.col("score").alias("threshold")).agg(
        F.count_if(F.col(LABEL) == 1).alias("v"), F.count_if(F.col(LABEL) == 0).alias("n")
    )).withColumns({"_all": F.lit(0), "_cell": roc_cell()})
    cells = per.groupBy("_all", "_cell").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    cells = R.prefix_sums(cells, ["_all"], "_cell").drop("n", "v", "_all")
    below = W.partitionBy("_cell").orderBy("threshold").rowsBetween(W.unboundedPreceding, -1)
    def rate(c):
        before = F.col(f"{c}_before") + F.coalesce(F.sum(c).over(below), F.lit(0))
        return F.try_divide((F.col(f"{c}_total") - before).cast("double"), F.col(f"{c}_total"))

    return per.join(cells, "_cell").select("threshold", rate("n").alias("fpr"), rate("v").alias("tpr"))


def curve_ends(curve: DataFrame) -> DataFrame:
    """(rises, last_fpr, last_tpr): whether both rates rise as the threshold falls, and their largest values.

    Neighbours are compared inside cells, and the ends of neighbouring cells, of which there are ``ROC_CELLS`` at most."""
    down = W.partitionBy("_cell").orderBy(F.desc("threshold"))
    falls = lambda order: reduce(lambda a, b: a | b, [F.col(c) < F.lag(f"{c}_end").over(order) for c in ("fpr", "tpr")])
    each = curve.withColumns({"_cell": roc_cell(), "fpr_end": F.col("fpr"), "tpr_end": F.col("tpr")}).withColumn("_falls", falls(down))
    cells = each.groupBy("_cell").agg(
        F.count_if("_falls").alias("n"), *[F.max(c).alias(f"_last_{c}") for c in ("fpr", "tpr")],
        *[F.max_by(c, "threshold").alias(c) for c in ("fpr", "tpr")], *[F.min_by(c, "threshold").alias(f"{c}_end") for c in ("fpr", "tpr")],
    )
    return cells.withColumn("_falls", falls(W.orderBy(F.desc("_cell")))).agg(
        ((F.coalesce(F.sum("n"), F.lit(0)) == 0) & (F.count_if("_falls") == 0)).alias("rises"), F.max("_last_fpr").alias("last_fpr"), F.max("_last_tpr").alias("last_tpr")
    )


def feature_importance(spark, model: PipelineModel) -> DataFrame:
    gains = model.stages[-1].featureImportances
    rows = [(f, float(g)) for f, g in zip(FEATURES, gains)]
    return spark.createDataFrame(rows, "feature string, importance double")
