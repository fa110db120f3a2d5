"""Per-row attributions of a boosted-tree model, in margin units.

Path-dependent Shapley values for trees (Lundberg et al., 2018): in each leaf
a feature either follows the path (the row decides) or is unknown (the share of
training rows that went that way).  Leaves are few and the same for every row, so
the model is broadcast, and Arrow batches go through all leaves with the same
features at once.
"""

from __future__ import annotations

from math import factorial

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.functions.exact import half_up
from mercata.ml.success import FEATURES

ROWS_AT_ONCE = 256  # rows that go through a group of leaves together
TABLED = 6          # features of a leaf, at most, whose 2 ** n ways to follow the path are tabled


def tree_leaves(model: PipelineModel, spark=None) -> tuple[list, float]:
    """Leaves of all trees as (value, {feature: (share, above, up_to)}), and the base value.

    The nodes are part of the model, bounded by the number of trees and their depth.
    """
    leaves, base = [], 0.0
    for tree in model.stages[-1].kept():
        total = tree.cover[0]
        stack = [(0, {})]
        while stack:
            at, path_so_far = stack.pop()
            if tree.feature[at] < 0:
                leaves.append((float(tree.value[at]), path_so_far))
                base += tree.value[at] * tree.cover[at] / total
                continue
            feature, cut = int(tree.feature[at]), float(tree.cut[at])
            for child, is_left in ((tree.left[at], True), (tree.right[at], False)):
                share, above, up_to = path_so_far.get(feature, (1.0, -np.inf, np.inf))
                share *= tree.cover[child] / tree.cover[at] if tree.cover[at] else 0.0
                bounds = (share, above, min(up_to, cut)) if is_left else (share, max(above, cut), up_to)
                stack.append((int(child), {**path_so_far, feature: bounds}))
    return leaves, float(base)


def leaf_groups(leaves: list) -> list[tuple]:
    """Leaves with the same features together: (features, values, shares, lower and upper bounds)."""
    groups: dict[tuple, list] = {}
    for value, path in leaves:
        groups.setdefault(tuple(sorted(path)), []).append((value, path))
    return [
        (
            features, np.array([v for v, _ in members]),
            *(np.array([[path[f][i] for f in features] for _, path in members]).reshape(len(members), len(features)) for i in range(3)),
        )
        for features, members in groups.items()
    ]


def leaf_shares(follows: np.ndarray, share: np.ndarray) -> list[np.ndarray]:
    """Each feature's part of a leaf's value, where ``follows`` (rows x leaves x features) tells which bounds a row meets."""
    m = follows.shape[2]
    weight = [factorial(k) * factorial(m - k - 1) / factorial(m) for k in range(m)]
    out = []
    for i in range(m):
        # by[k]: sum over sets of k known other features of their joint path share
        by = [np.ones(follows.shape[:2])]
        for j in range(m):
            if j != i:
                grown = [b * share[:, j] for b in by]
                grown.append(by[-1] * follows[:, :, j])
                for k in range(len(by) - 1):
                    grown[k + 1] += by[k] * follows[:, :, j]
                by = grown
        known = sum(w * b for w, b in zip(weight, by))
        out.append((follows[:, :, i] - share[:, i]) * known)
    return out


def tabled(groups: list[tuple], rows: int) -> list[tuple]:
    """The groups, each with a table (leaf and way to follow its path) of the features' parts and the margin's; None where
    there are more ways than ``rows`` or the path has more than ``TABLED`` features."""
    out = []
    for features, value, share, above, up_to in groups:
        m, table = len(features), None
        if 0 < m <= TABLED and 2**m <= rows:
            ways = (np.arange(2**m)[:, None] >> np.arange(m) & 1).astype(float)
            follows = np.repeat(ways[:, None, :], len(value), axis=1)
            parts = [*leaf_shares(follows, share), follows.prod(axis=2)]
            table = np.stack([(p * value).T for p in parts], axis=2).reshape(-1, m + 1)  # leaf * 2 ** m + way
        out.append((features, value, share, above, up_to, table))
    return out


def shapley_batch(x: np.ndarray, groups: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Attributions and margin of each row of a feature matrix; ``groups`` may have been :func:`tabled`."""
    phi, margin = np.zeros(x.shape), np.zeros(len(x))
    for at in range(0, len(x), ROWS_AT_ONCE):
        rows = slice(at, at + ROWS_AT_ONCE)
        for features, value, share, above, up_to, *table in groups:
            m = len(features)
            if not m:
                margin[rows] += value.sum()
                continue
            columns = list(features)
            if table and table[0] is not None:
                way = np.zeros((len(x[rows]), len(value)), np.intp) + np.arange(len(value)) * 2**m
                for j, f in enumerate(columns):
                    held = x[rows, f, None]
                    way += ((held > above[:, j]) & (held <= up_to[:, j])).astype(np.intp) << j
                parts = table[0][way].sum(axis=1)
                phi[rows, columns] += parts[:, :m]
                margin[rows] += parts[:, m]
                continue
            held = x[rows][:, None, columns]
            follows = ((held > above) & (held <= up_to)).astype(float)  # rows x leaves x features
            margin[rows] += follows.prod(axis=2) @ value
            for f, part in zip(columns, leaf_shares(follows, share)):
                phi[rows, f] += part @ value
    return phi, margin


def join_leaves(rows: DataFrame, leaves: DataFrame, features: list[str]) -> DataFrame:
    """Each row (key, features) with the values of the leaves it falls into; ``leaves`` has a row (leaf, value, feature, above,
    up_to) for each bound.  The bounds of a leaf become columns, so that the join compares plain numbers and stops at the
    first bound a row misses."""
    held = lambda i, c: F.max(F.when(F.col("feature") == i, F.col(c)))
    wide = leaves.groupBy("leaf", "value").agg(*[
        held(i, c).alias(f"_{c}_{i}") for i in range(len(features)) for c in ("above", "up_to")
    ])
    inside = F.lit(True)
    for i, f in enumerate(features):  # a feature without bounds has nulls
        inside &= F.coalesce(F.col(f) > F.col(f"_above_{i}"), F.lit(True)) & F.coalesce(F.col(f) <= F.col(f"_up_to_{i}"), F.lit(True))
    return rows.join(F.broadcast(wide), inside).select(*rows.columns, "leaf", "value")


def explain(model: PipelineModel, df: DataFrame, leaves: tuple[list, float] | None = None) -> DataFrame:
    """Add ``shap_<feature>``, ``base_value``, ``margin`` and ``probability`` to each row.

    Attributions and base value add up to the margin; the probability is the model's.  ``leaves``, from
    :func:`tree_leaves`, spares reading the trees out of the model again.
    """
    spark = df.sparkSession
    found, base = leaves or tree_leaves(model, spark)
    shared = spark.sparkContext.broadcast((leaf_groups(found), base))

    def run(batches):
        groups, base = shared.value
        ready = None
        for batch in batches:
            ready = ready or tabled(groups, len(batch))
            phi, margin = shapley_batch(batch[FEATURES].to_numpy(float), ready)
            out = {f"shap_{f}": phi[:, i] for i, f in enumerate(FEATURES)}
            yield batch.assign(
                **out, base_value=base, margin=margin, probability=1 / (1 + np.exp(-2 * margin))
            )

    fields = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
        + [f"shap_{f} double" for f in FEATURES]
        + ["base_value double", "margin double", "probability double"]
    )
    return df.mapInPandas(run, fields)


def shap_summary(explained: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, and the shift from low to high values.

    High means above the feature's exact median over the explained rows.
    """
    from mercata.operators.ranks import medians as medians_of
    from mercata.operators.relational import add_single_row

    rated = explained.select(*FEATURES, *[f"shap_{f}" for f in FEATURES])
    medians = medians_of(rated, {f"_m_{f}": f for f in FEATURES})
    rows = F.array(*[
        F.struct(
            F.lit(f).alias("feature"), F.col(f"shap_{f}").alias("shap"),
            (F.col(f) > F.col(f"_m_{f}")).alias("high"),
        )
        for f in FEATURES
    ])
    long = add_single_row(rated, medians).select(F.explode(rows).alias("_r")).select("_r.*")
    high = F.coalesce(F.avg(F.when(F.col("high"), F.col("shap"))), F.lit(0.0))
    low = F.coalesce(F.avg(F.when(~F.col("high"), F.col("shap"))), F.lit(0.0))
    return long.groupBy("feature").agg(
        F.avg(F.abs("shap")).alias("mean_abs_shap"), high.alias("avg_shap_high"), low.alias("avg_shap_low"),
        (high - low).alias("direction"),
    )


def waterfall(explained: DataFrame, k: int = 1, success: bool = True) -> DataFrame:
    """Attributions, one row each, of the k listings surest to succeed (or to fail) that did."""
    picked = explained.where(F.col("is_success") == (1 if success else 0)).orderBy(
        F.desc("probability") if success else F.asc("probability"), "asin"
    ).limit(k)
    rows = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).alias("value"), F.col(f"shap_{f}").alias("shap"))
        for f in FEATURES
    ])
    return picked.select("asin", "base_value", "margin", F.explode(rows).alias("_r")).select(
        "asin", "base_value", "margin", "_r.*"
    )
