"""Boosted trees in one fit: second-order steps on the logistic loss, stopped with patience.

Bins end at exact quantiles of all training rows.  A tree grows level by level; a level takes one pass over all rows, which
carries the margins forward from where they were stored last and adds up gradients and curvatures by node, feature and bin.
The first pass of a round also measures the loss of the rounds before on the validation fold.  All sums over rows are of
whole numbers, so the model is the same in any order and partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mercata.session import drop_path, scratch_path, shared_dir
from mercata.sources.tables import materialize

HELD_ROWS = 100_000   # rows that the driver holds as one batch; more are passed over where they lie
BINS = 128            # of a feature, at most
DRAWN = 0.8           # share of features drawn for each tree
LEAST_CURVATURE = 5.0  # in each child of a split
SHRINK = 1.0          # added to the curvature of a leaf
UNIT = 1 << 20        # gradients are added up in whole multiples of 1 / UNIT
STORED_EVERY = 10     # rounds between two writes of the margins
FEW_PARTS = 64        # tasks whose sums are collected without a shuffle


class Tree(NamedTuple):
    """Nodes by number, the root first.  Rows whose value is at most ``cut`` (bin at most ``bin``) go left."""

    feature: np.ndarray  # -1 in a leaf
    bin: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    gain: np.ndarray
    value: np.ndarray
    cover: np.ndarray    # training rows

    def leaves(self, rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Leaf of each row; ``bounds`` are the nodes' bins or cuts, as the rows are binned or not."""
        at, line = np.zeros(len(rows), int), np.arange(len(rows))
        while True:
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                return at
            down = np.where(rows[line, np.maximum(feature, 0)] <= bounds[at], self.left[at], self.right[at])
            at = np.where(inner, down, at)


def cuts_of(train: DataFrame, features: list[str]) -> list[np.ndarray]:
    """Upper bounds of each feature's bins, all but the last: the values at every ``BINS``-th part of all rows.

    Values are counted, the counts dealt by ranges of neighbouring values, and added up in each range and over the ranges.
    """
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).alias("x")) for i, c in enumerate(features)]))
    counts = train.select(each.alias("_e")).groupBy("_e.f", "_e.x").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(train.sparkSession, "values")
    ranges = materialize(counts.repartitionByRange("f", "x").withColumn("range", F.spark_partition_id()), path)
    sums = ranges.groupBy("f", "range").agg(F.sum("n").alias("_rows"), F.max("x").alias("_max"))
    feature, earlier = W.partitionBy("f"), W.partitionBy("f").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(  # as many rows as ranges, and one more for each feature
        "f", "range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("start"),
        F.greatest(F.sum("_rows").over(feature) - 1, F.lit(1)).alias("last"), F.max("_max").over(feature).alias("most"),
    )
    smaller = F.sum("n").over(W.partitionBy("f", "range").orderBy("x").rowsBetween(W.unboundedPreceding, -1))
    placed = ranges.join(F.broadcast(starts), ["f", "range"]).withColumn("before", F.col("start") + F.coalesce(smaller, F.lit(0)))
    nth = F.greatest(F.lit(1), F.expr(f"(before * {BINS} + last - 1) div last"))  # the first part that doesn't end before these rows
    ends = placed.withColumn("nth", nth).where(
        (F.col("nth") < BINS) & (F.expr(f"nth * last div {BINS}") < F.col("before") + F.col("n")) & (F.col("x") < F.col("most"))
    )
    found: list[list[float]] = [[] for _ in features]
    for r in ends.select("f", "x").collect():
        found[r.f].append(r.x)
    drop_path(train.sparkSession, path)
    return [np.sort(np.array(x, float)) for x in found]


def binned(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x, side="left") for c, x in zip(cuts, values.T)], axis=1).astype(np.uint8)


def slopes(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the loss; margins are half log odds."""
    p = 1 / (1 + np.exp(-2 * margin))
    return weight * (p - label), weight * p * (1 - p)


def losses(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return weight * np.logaddexp(0, np.where(label > 0, -2, 2) * margin)


def splits(sums: np.ndarray, columns: np.ndarray) -> list[tuple[float, int, int]]:
    """Gain, feature and bin of each node's best split, from (g, h, n) by node, column and bin; ties to the first feature and bin."""
    score = lambda a, b: a * a / (b + SHRINK)
    best = [(0.0, -1, 0)] * sums.shape[1]
    for place, f in enumerate(columns):
        gl, hl = (sums[i, :, place].cumsum(axis=1) / UNIT for i in (0, 1))
        ga, ha = gl[:, -1:], hl[:, -1:]
        gain = score(gl, hl) + score(ga - gl, ha - hl) - score(ga, ha)
        gain[(hl < LEAST_CURVATURE) | (ha - hl < LEAST_CURVATURE)] = 0.0
        for i, b in enumerate(gain.argmax(axis=1)):
            if gain[i, b] > best[i][0] + 1e-9:
                best[i] = (float(gain[i, b]), int(f), int(b))
    return best


def grown(one_pass, columns: np.ndarray, depth: int, cuts: list[np.ndarray], step: float) -> tuple[Tree, float | None]:
    """A tree level by level: each node splits where the second-order gain is largest.  Also the loss before it.

    ``one_pass(tree, level)`` gives the loss and the sums of the level's nodes."""
    feature, split, left, right, gains = [-1], [0], [-1], [-1], [0.0]
    level, totals, loss = [0], {}, None
    for d in range(depth):
        none = np.zeros(len(feature))
        so_far = Tree(*map(np.array, (feature, split, none, left, right, gains)), none, none)
        judged, sums = one_pass(so_far, level)
        if d == 0:
            loss, totals[0] = judged, sums[:, 0, 0].sum(axis=1)
        following = []
        for i, (node, (gain, f, b)) in enumerate(zip(level, splits(sums, columns))):
            if f < 0:
                continue
            feature[node], split[node], gains[node] = f, b, gain
            left[node], right[node] = len(feature), len(feature) + 1
            totals[left[node]] = sums[:, i, list(columns).index(f), : b + 1].sum(axis=1)
            totals[right[node]] = totals[node] - totals[left[node]]
            following += [left[node], right[node]]
            for extra, blank in ((feature, -1), (split, 0), (left, -1), (right, -1), (gains, 0.0)):
                extra += [blank, blank]
        level = following
        if not level:
            break
    cut = [float(cuts[f][b]) if f >= 0 else 0.0 for f, b in zip(feature, split)]
    none = np.zeros(len(feature))
    tree = Tree(*map(np.array, (feature, split, cut, left, right, gains)), none, none)
    return valued(tree, {node: tuple(map(int, t)) for node, t in totals.items() if feature[node] < 0}, step), loss


def valued(tree: Tree, sums: dict[int, tuple[int, int, int]], step: float) -> Tree:
    """The tree with its leaves' values and all nodes' covers, from (gradient, curvature, rows) of the leaves."""
    value, cover = np.zeros(len(tree.feature)), np.zeros(len(tree.feature))
    for leaf, (g, h, n) in sums.items():
        value[leaf], cover[leaf] = -0.5 * step * (g / UNIT) / (h / UNIT + SHRINK), n
    for node in range(len(cover) - 1, -1, -1):  # children have larger numbers
        if tree.feature[node] >= 0:
            cover[node] = cover[tree.left[node]] + cover[tree.right[node]]
    return tree._replace(value=value, cover=cover)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _carried(stored: np.ndarray, bins: np.ndarray, trees: list[Tree]) -> np.ndarray:
    for tree in trees:
        stored = stored + tree.value[tree.leaves(bins, tree.bin)]
    return stored


class Batch(NamedTuple):
    """Rows of both folds with the margins that were stored last."""

    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    train: np.ndarray
    margin: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table, width: int) -> "Batch":
        return cls(_matrix(batch.column(0), width), *(np.asarray(batch.column(i)) for i in range(1, 5)))


def tally(batch: Batch, trees: list[Tree], tree: Tree, level: list[int], columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss and weight of the rows that judge, with ``trees``; gradient, curvature and number of the training rows in the
    level's nodes of ``tree``, by node, column and bin."""
    margin = _carried(batch.margin, batch.bins, trees)
    judged = ~batch.train
    whole = lambda x: np.rint(x * UNIT)
    loss = [whole(losses(margin[judged], batch.label[judged], batch.weight[judged])).sum(), whole(batch.weight[judged]).sum()]
    place = np.full(len(tree.feature), -1)
    place[level] = np.arange(len(level))
    here = np.where(batch.train, place[tree.leaves(batch.bins, tree.bin)], -1)
    rows = np.flatnonzero(here >= 0)
    cell = (here[rows, None] * len(columns) + np.arange(len(columns))) * BINS + batch.bins[rows][:, columns]
    shape = (len(level), len(columns), BINS)
    sums = [
        np.bincount(cell.ravel(), weights=None if x is None else np.repeat(whole(x), len(columns)), minlength=np.prod(shape)).astype(np.int64)
        for x in (*slopes(margin[rows], batch.label[rows], batch.weight[rows]), None)
    ]
    return np.array(loss, np.int64), np.stack(sums).reshape(3, *shape)


SUMS = "node int, sums binary"


def _summed(table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x, np.int64) for x in table.column("sums").to_pylist()], axis=0)
    return pa.table({"node": table.column("node").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})


def passed(
    rows: DataFrame, partitions: int, width: int, trees: list[Tree], tree: Tree, level: list[int], columns: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """:func:`tally` of all rows.  A task hands on its sums node by node; of many tasks these are added up before they are collected."""
    types = pa.schema([("node", pa.int32()), ("sums", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, sums = np.zeros(2, np.int64), np.zeros((3, len(level), len(columns), BINS), np.int64)
        for batch in batches:
            found = tally(Batch.of(batch, width), trees, tree, level, columns)
            loss, sums = loss + found[0], sums + found[1]
        own = [loss.tobytes(), *(sums[:, i].tobytes() for i in range(len(level)))]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(level)), pa.int32()), pa.array(own, pa.binary())], schema=types)

    parts = rows.mapInArrow(run, SUMS)
    if partitions > FEW_PARTS:
        parts = parts.groupBy("node").applyInArrow(_summed, SUMS)
    loss, sums = np.zeros(2, np.int64), np.zeros((3, len(level), len(columns), BINS), np.int64)
    for r in parts.collect():
        found = np.frombuffer(r.sums, np.int64)
        if r.node < 0:
            loss = loss + found
        else:
            sums[:, r.node] += found.reshape(3, len(columns), BINS)
    return loss, sums


BINNED = "bins binary, label double, weight double, train boolean, margin double"


class Spread:
    """Rows written to the shared folder, each time anew with the margins carried forward; what was written before goes."""

    def __init__(self, rows: DataFrame, width: int):
        self.width, self.path = width, scratch_path(rows.sparkSession, "boosting")
        self.rows = materialize(rows, self.path)
        self.partitions = self.rows.rdd.getNumPartitions()

    def passed(self, *of) -> tuple[np.ndarray, np.ndarray]:
        return passed(self.rows, self.partitions, self.width, *of)

    def carry(self, trees: list[Tree]) -> "Spread":
        width = self.width

        def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                margin = _carried(batch.column(4).to_numpy(), _matrix(batch.column(0), width), trees)
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(margin)], names=batch.schema.names)

        after = Spread(self.rows.mapInArrow(forward, BINNED), width)
        self.drop()
        return after

    def drop(self) -> None:
        drop_path(self.rows.sparkSession, self.path)


class Held:
    """Few rows, in the driver: the same sums without a job for each."""

    def __init__(self, batch: Batch):
        self.batch = batch

    def passed(self, *of) -> tuple[np.ndarray, np.ndarray]:
        return tally(self.batch, *of)

    def carry(self, trees: list[Tree]) -> "Held":
        return Held(self.batch._replace(margin=_carried(self.batch.margin, self.batch.bins, trees)))

    def drop(self) -> None:
        pass


def fit(df: DataFrame, features: list[str], key: str, max_iter: int, depth: int, step: float, seed: int, patience: int, keep) -> "BoostedModel":
    """Fit rows of (key, features, label, weight, train); rows that are not ``train`` judge when to stop.

    ``keep(losses, patience)`` tells how many rounds to keep, or None to go on.  Without judging rows all rounds are kept.
    """
    shared_dir(df.sparkSession)
    width = len(features)
    cuts = cuts_of(df.where("train"), features)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)], axis=1)
            bins = [bytes(r) for r in binned(x, cuts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bins, pa.binary()), *batch.columns[width:], pa.array(np.zeros(len(bins)))],
                names=["bins", "label", "weight", "train", "margin"],
            )

    data: Spread | Held = Spread(df.select(*features, "label", "weight", "train").mapInArrow(cut, BINNED), width)
    if data.rows.count() <= HELD_ROWS:
        spread, data = data, Held(Batch.of(data.rows.toArrow(), width))
        spread.drop()
    trees, recent, curve, kept = [], [], [], None
    while kept is None:
        draw = np.random.default_rng([seed, len(trees)])
        columns = np.sort(draw.choice(width, max(1, round(DRAWN * width)), replace=False))
        more = len(trees) < max_iter

        def one_pass(tree: Tree, level: list[int]):
            (loss, weight), sums = data.passed(recent, tree, level, columns)
            return loss / weight if weight else None, sums

        tree, loss = grown(one_pass, columns, depth if more else 1, cuts, step)
        if trees and loss is not None:
            curve.append(float(loss))
            kept = keep(curve, patience)
        if not more:
            kept = kept or (curve.index(min(curve)) + 1 if curve else len(trees))
        if kept is None:
            trees.append(tree)
            recent.append(tree)
            if len(recent) == STORED_EVERY:
                data, recent = data.carry(recent), []
    data.drop()
    return BoostedModel(features=features, trees=[[x.tolist() for x in t] for t in trees[:kept]], lossCurve=curve)


class BoostedModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted model as a pipeline stage: adds ``rawPrediction`` (the margin, half log odds), ``probability`` and ``prediction``."""

    features = Param(Params._dummy(), "features", "feature columns")
    trees = Param(Params._dummy(), "trees", "nodes of the kept trees, the fields of Tree in order")
    lossCurve = Param(Params._dummy(), "lossCurve", "mean loss on the validation fold after each round tried")

    @keyword_only
    def __init__(self, *, features=None, trees=None, lossCurve=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def getNumTrees(self) -> int:
        return len(self.getOrDefault(self.trees))

    def kept(self) -> list[Tree]:
        return [Tree(*map(np.array, t)) for t in self.getOrDefault(self.trees)]

    @property
    def featureImportances(self) -> np.ndarray:
        """Share of each feature in the gains of all splits."""
        total = np.zeros(len(self.getOrDefault(self.features)))
        for tree in self.kept():
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
        return total / total.sum() if total.sum() else total

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = self.kept()

        @F.pandas_udf("double")
        def margin(x: pd.DataFrame) -> pd.Series:
            rows = x.to_numpy(float)
            return pd.Series(sum((t.value[t.leaves(rows, t.cut)] for t in trees), np.zeros(len(rows))))

        inputs = F.struct(*[F.col(f).cast("double").alias(f) for f in self.getOrDefault(self.features)])
        out = dataset.withColumn("rawPrediction", margin(inputs))
        out = out.withColumn("probability", 1 / (1 + F.exp(-2 * F.col("rawPrediction"))))
        return out.withColumn("prediction", (F.col("probability") >= 0.5).cast("double"))
