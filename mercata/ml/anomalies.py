"""Review anomalies: signals per product, an isolation forest, and trust scores.

The forest (Liu et al., 2008) is grown from small random subsamples, one per
tree, drawn by hash and fitted one tree per group.  The finished trees are a
table of bounded size, broadcast to score all rows batch by batch.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mercata.ml.clusters import checkpointed
from mercata.operators.ranks import quantiles
from mercata.operators.relational import add_single_row
from mercata.plans.analysis import TRUST_FEATURES
from mercata.plans.gold_reviews import PRODUCT, join_trust

EULER = 0.5772156649015329  # fixed value
SCORE_UNIT = 10**9          # scores are kept as whole billionths, so ranks are exact


def finite(c):
    """Null, infinite and not-a-number values as zero."""
    bad = F.col(c).isNull() | F.isnan(c) | F.col(c).isin(float("inf"), float("-inf"))
    return F.when(bad, F.lit(0.0)).otherwise(F.col(c).cast("double"))


def trust_features(trust: DataFrame, summary: DataFrame, min_reviews: int = 5) -> DataFrame:
    """Twelve signals per product and category, rates as 0..1, gaps filled with zero."""
    joined = join_trust(trust, summary, min_reviews).withColumns({
        "unverified_5star_gap": F.col("pct_5star_unverified") - F.col("pct_5star_verified"),
        "extreme_ratio": F.col("pct_extreme_ratings") / 100,
        "text_rate": F.col("pct_with_text") / 100,
        "verified_rate": F.col("pct_verified") / 100,
        "short_text_rate": F.col("pct_very_short_text") / 100,
    })
    return joined.select(*PRODUCT, "review_count", *[finite(f).alias(f) for f in TRUST_FEATURES])


def expected_path(n):
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    many = np.maximum(n, 3)
    full = 2 * (np.log(many - 1) + EULER) - 2 * (many - 1) / many
    return np.where(n > 2, full, np.where(n == 2, 1.0, 0.0))


def _draw(*parts):
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def tree_samples(df: DataFrame, trees: int, size: int, seed: int) -> DataFrame:
    """At most ``size`` distinct rows for each tree, drawn from all rows.

    Every row joins every tree by an independent draw.  One draw per row tells the first tree it joins,
    if any, so the further trees are drawn for the few rows that join one.
    """
    key = F.concat_ws("|", *PRODUCT)
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    slack = size + 6 * size**0.5
    chance = F.least(F.lit(1.0), F.lit(slack) / F.col("_n"))
    draws = F.log1p(-_draw("_key", F.lit(seed))) / F.log1p(-F.col("_chance"))  # failures before the first success
    first = F.when(F.col("_chance") >= 1, F.lit(0)).otherwise(F.least(F.floor(draws), F.lit(trees)).cast("int"))
    later = F.filter(
        F.sequence(F.col("_first") + 1, F.lit(trees)),
        lambda t: (t < trees) & (_draw(F.col("_key"), t, F.lit(seed + 1)) < F.col("_chance")),
    )
    drawn = (
        add_single_row(df.withColumn("_key", key), total)
        .withColumn("_chance", chance).withColumn("_first", first).where(F.col("_first") < trees)
        .withColumn("tree", F.explode(F.concat(F.array("_first"), later)))
    )
    order = W.partitionBy("tree").orderBy(_draw("_key", "tree", F.lit(seed + 2)), "_key")
    return drawn.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= size).select(
        "tree", "_nth", *TRUST_FEATURES
    )


NODE_SCHEMA = "tree int, node int, feature int, cut double, left int, right int, path double, rows int"


def grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Random splits until rows stand alone, agree, or the depth runs out.

    Returns (feature, cut, left, right, path, rows); leaves have feature -1 and their
    depth plus the expected rest.
    """
    nodes: list[tuple] = []

    def grow(rows: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append(())
        low, high = rows.min(axis=0), rows.max(axis=0)
        varied = np.flatnonzero(high > low)
        if depth >= max_depth or len(rows) <= 1 or not len(varied):
            nodes[at] = (-1, 0.0, -1, -1, depth + float(expected_path(len(rows))), len(rows))
            return at
        f = int(rng.choice(varied))
        cut = min(float(rng.uniform(low[f], high[f])), float(np.nextafter(high[f], low[f])))  # below the highest, however near they lie
        goes_left = rows[:, f] <= cut
        left = grow(rows[goes_left], depth + 1)
        right = grow(rows[~goes_left], depth + 1)
        nodes[at] = (f, cut, left, right, 0.0, len(rows))
        return at

    grow(x, 0)
    return nodes


def fit_forest(features: DataFrame, trees: int = 200, size: int = 256, seed: int = 42) -> DataFrame:
    """The forest as a node table.  Every tree is grown in its own group of at most ``size`` rows."""
    max_depth = int(np.ceil(np.log2(size)))

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_nth")
        rng = np.random.default_rng([seed, int(key[0])])
        nodes = grow_tree(rows[TRUST_FEATURES].to_numpy(float), rng, max_depth)
        out = pd.DataFrame(nodes, columns=["feature", "cut", "left", "right", "path", "rows"])
        out.insert(0, "node", np.arange(len(out)))
        out.insert(0, "tree", int(key[0]))
        return out

    return tree_samples(features, trees, size, seed).groupBy("tree").applyInPandas(fit, NODE_SCHEMA)


def _tree_arrays(nodes: DataFrame) -> tuple[list[tuple], int]:
    """Trees as arrays, and the rows a tree saw; bounded by trees and rows per tree."""
    table = nodes.orderBy("tree", "node").toPandas()
    arrays = [
        tuple(g[c].to_numpy() for c in ("feature", "cut", "left", "right", "path"))
        for _, g in table.groupby("tree")
    ]
    return arrays, int(table["rows"].max())


def mean_path(x: np.ndarray, trees: list[tuple]) -> np.ndarray:
    """Average depth at which each row ends, over the trees."""
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for feature, cut, left, right, path in trees:
        at = np.zeros(len(x), int)
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            goes_left = x[rows, np.maximum(f, 0)] <= cut[at]
            at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
        total += path[at]
    return total / len(trees)


def raw_scores(features: DataFrame, nodes: DataFrame) -> DataFrame:
    """Add ``raw_score`` in billionths: minus the anomaly score, so lower is more anomalous."""
    spark = features.sparkSession
    shared = spark.sparkContext.broadcast(_tree_arrays(nodes))

    def run(batches):
        trees, seen = shared.value
        typical = float(expected_path(seen))
        for batch in batches:
            score = -np.exp2(-mean_path(batch[TRUST_FEATURES].to_numpy(float), trees) / typical)
            yield batch.assign(raw_score=np.rint(score * SCORE_UNIT).astype("int64"))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in features.schema.fields)
    return features.mapInPandas(run, f"{fields}, raw_score long")


def score_trust(
    features: DataFrame, trees: int = 200, contamination: float = 0.05, size: int = 256, seed: int = 42
) -> DataFrame:
    """Trust score 0..100 per row (higher is better) and the suspicious flag.

    The rows below the exact ``contamination`` quantile of the raw score are flagged.
    """
    base = checkpointed(features)
    scored = checkpointed(raw_scores(base, checkpointed(fit_forest(base, trees, size, seed))))
    bounds = add_single_row(
        scored.agg(F.min("raw_score").alias("_lo"), F.max("raw_score").alias("_hi")),
        quantiles(scored, [], {"_cut": ("raw_score", contamination, None, 1)}),
    )
    share = F.try_divide((F.col("raw_score") - F.col("_lo")).cast("double"), F.col("_hi") - F.col("_lo"))
    return add_single_row(scored, bounds).withColumns({
        "trust_score": F.coalesce(F.floor(share * 1000 + 0.5) / 10.0, F.lit(100.0)),
        "is_suspicious": F.col("raw_score") < F.col("_cut"),
    }).drop("_lo", "_hi", "_cut")


def product_trust_scores(
    trust: DataFrame, summary: DataFrame, min_reviews: int = 5, trees: int = 200, contamination: float = 0.05
) -> DataFrame:
    scored = score_trust(trust_features(trust, summary, min_reviews), trees, contamination)
    return scored.select(*PRODUCT, "review_count", "trust_score", *TRUST_FEATURES, "is_suspicious")


def trust_cutoff(scores: DataFrame) -> DataFrame:
    """The highest trust score among flagged rows: the cut-off to store with the model."""
    return scores.where("is_suspicious").agg(F.max("trust_score").alias("trust_cutoff"))
