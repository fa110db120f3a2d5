"""K-Means with one answer for one set of rows, however they are ordered and partitioned.

Features are scaled by exact moments and kept as whole numbers of ``1 / UNIT`` deviations, so that all sums over rows are
exact.  Seeds are drawn by hash of the row's key (k-means||): a few passes collect some candidates, another
weighs them, and k-means++ on the weighted candidates picks the centres to start from.  Every pass over
the rows, of seeding and of Lloyd's steps, serves all models asked for at once; what reaches the driver
are sums per cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.session import shared_dir

UNIT = 1 << 20      # scaled features are whole multiples of 1 / UNIT
MOMENT = 10**9      # moments are taken of features in whole multiples of 1 / MOMENT
ROUNDS = 5          # passes that draw candidates
DRAWN = 2           # expected candidates a pass, times the largest k
STARTS = 10         # seedings tried on the candidates, of which the cheapest is used
START_SAMPLE = 20_000  # rows by key hash on which centres move first
TOLERANCE = 1e-4    # a model is done when the squared moves of its centres, in deviations, add up to no more
SILHOUETTE_SAMPLE = 50_000  # rows by key hash that silhouettes are taken of
BLOCK = 1_000       # rows of the sample that a task compares with the sample
STRIP = 50          # of these, rows whose distances are in memory at once: 20 MB for the largest sample


def moments(df: DataFrame, features: list[str]) -> list[tuple[float, float]]:
    """Mean and sample deviation of each feature, from exact sums."""
    fixed = lambda f: F.round(F.col(f).cast("double") * MOMENT).cast("decimal(19,0)")
    row = df.agg(F.count(F.lit(1)), *[F.sum(fixed(f)) for f in features], *[F.sum(fixed(f) * fixed(f)) for f in features]).first()
    n, out = row[0], []
    for one, two in zip(row[1:1 + len(features)], row[1 + len(features):]):
        one, two = Fraction(int(one or 0), MOMENT), Fraction(int(two or 0), MOMENT * MOMENT)
        spread = (two - one * one / n) / (n - 1) if n > 1 else Fraction(0)
        out.append((float(one / n) if n else 0.0, float(spread) ** 0.5))
    return out


def scaled(features: list[str], scale: list[tuple[float, float]]) -> Column:
    """The features as an array of whole multiples of 1 / UNIT; one that does not vary is 0."""
    units = [
        F.round((F.col(f).cast("double") - mean) / spread * UNIT).cast("long") if spread else F.lit(0).cast("long")
        for f, (mean, spread) in zip(features, scale)
    ]
    return F.array(*units)


def draw(seed: int, key: str) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11).cast("double") / F.lit(float(1 << 53))


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, added up dimension by dimension, so that a row's are the same in every batch."""
    out = np.zeros((len(rows), len(centres)))
    for j in range(centres.shape[1]):
        part = rows[:, j, None] - centres[None, :, j]
        part *= part
        out += part
    return out


def rows_of(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)


def tallies(points: DataFrame, models: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Per model (rows, sums) of its clusters and its cost, of one pass over the points."""
    dims = models[0].shape[1]
    types = pa.schema([("model", pa.int32()), ("cluster", pa.int32()), ("part", pa.int32()), ("value", pa.int64())])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(m), dims + 2), np.int64) for m in models]
        for batch in batches:
            rows = rows_of(batch.column(0), dims)
            for total, centres in zip(totals, models):
                away = distances(rows, centres)
                near = away.argmin(axis=1)
                size = len(centres)
                total[:, 0] += np.bincount(near, minlength=size)
                cost = np.rint(away[np.arange(len(rows)), near] / UNIT)
                for at, values in enumerate([cost, *rows.T], 1):  # whole numbers far below 2**53 in sum
                    total[:, at] += np.bincount(near, weights=values, minlength=size).astype(np.int64)
        found = [(m, c, p, int(v)) for m, total in enumerate(totals) for (c, p), v in np.ndenumerate(total) if v]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*found), types)], schema=types)

    out = [np.zeros((len(m), dims + 2), dtype=object) for m in models]
    parts = points.select("z").mapInArrow(tally, "model int, cluster int, part int, value long")
    for r in parts.groupBy("model", "cluster", "part").agg(F.sum("value").alias("value")).collect():
        out[r.model][r.cluster, r.part] = r.value
    return [(t[:, 0], t[:, 2:], int(t[:, 1].sum())) for t in out]


def away(point: Column, centre: list[float]) -> Column:
    out = F.lit(0.0)
    for j, c in enumerate(centre):
        part = F.get(point, F.lit(j)).cast("double") - F.lit(float(c))
        out = out + part * part
    return out


def candidates(points: DataFrame, most: int, seed: int) -> np.ndarray:
    """Different rows, about ``ROUNDS * DRAWN * most`` of them, drawn with chances that grow with the squared distance
    to those drawn before."""
    first = drawn(points, seed, 1)
    if not len(first):
        raise ValueError("no rows to cluster")
    dims, found = first.shape[1], {tuple(int(x) for x in first[0])}
    for turn in range(1, ROUNDS + 1):
        known = np.array(sorted(found), float)

        def near(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                least = distances(rows_of(batch.column(0), dims), known).min(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], names=["z", "draw", "least"])

        measured = points.select("z", draw(seed + turn, "key").alias("draw")).mapInArrow(
            near, "z array<long>, draw double, least double"
        ).persist()
        total = measured.agg(F.sum(F.rint(F.col("least") / UNIT).cast("long"))).first()[0] or 0
        if total:
            chance = F.col("least") * (DRAWN * most / (float(total) * UNIT))
            found |= {tuple(r.z) for r in measured.filter(F.col("draw") < chance).select("z").collect()}
        measured.unpersist()
        if not total:
            break
    return np.array(sorted(found), float)


def moved(centres: np.ndarray, held, sums) -> np.ndarray:
    """Means of the clusters' rows; a cluster without rows stays."""
    means = [[float(Fraction(int(s), int(n))) for s in row] if n else old.tolist() for n, row, old in zip(held, sums, centres)]
    return np.array(means)


def settled(old: np.ndarray, new: np.ndarray) -> bool:
    return float(np.square((new - old) / UNIT).sum()) <= TOLERANCE


def improved(rows: np.ndarray, weights: np.ndarray, centres: np.ndarray, max_iter: int) -> np.ndarray:
    """Lloyd's steps on a few weighted rows."""
    for _ in range(max_iter):
        near = distances(rows, centres).argmin(axis=1)
        held = np.bincount(near, weights=weights, minlength=len(centres))
        sums = np.stack([np.bincount(near, weights=weights * x, minlength=len(centres)) for x in rows.T], axis=1)
        old, centres = centres, moved(centres, held, sums)
        if settled(old, centres):
            break
    return centres


def seeded(known: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres to start from: the cheapest of ``STARTS`` k-means++ seedings of the weighted candidates, each improved on them."""
    random, best = np.random.RandomState(seed), None
    for _ in range(STARTS):
        picked = [int(random.choice(len(known), p=weights / weights.sum()))]
        while len(picked) < min(k, len(known)):
            mass = weights * distances(known, known[picked]).min(axis=1)
            if not mass.sum():
                break
            picked.append(int(random.choice(len(known), p=mass / mass.sum())))
        centres = improved(known, weights, known[picked], max_iter=30)
        cost = float((weights * distances(known, centres).min(axis=1)).sum())
        if best is None or cost < best[0]:
            best = cost, centres
    return best[1]


def drawn(points: DataFrame, seed: int, size: int) -> np.ndarray:
    """The ``size`` points with the smallest key hashes, in that order."""
    return np.array([r.z for r in points.select("z").orderBy(F.xxhash64(F.lit(seed), "key"), "z").limit(size).collect()], float)


def fit(points: DataFrame, ks: list[int], seed: int, max_iter: int) -> list[tuple[np.ndarray, float]]:
    """Centres (in units, in order of their coordinates) and cost (in squared deviations) for each k, of points (key, z).

    A bounded sample brings the centres near to where they end, then they move on all rows until they rest.
    A table with fewer different rows than k has as many centres as different rows; one without rows has no model.
    """
    known = candidates(points, max(ks), seed)
    weights = tallies(points, [known])[0][0].astype(float)
    rows = drawn(points, seed, START_SAMPLE)
    models = [improved(rows, np.ones(len(rows)), seeded(known, weights, k, seed + k), max_iter) for k in ks]
    moving = list(range(len(models)))
    for _ in range(max_iter):
        still = []
        for at, (held, sums, _) in zip(moving, tallies(points, [models[i] for i in moving])):
            old, models[at] = models[at], moved(models[at], held, sums)
            if not settled(old, models[at]):
                still.append(at)
        moving = still
        if not moving:
            break
    models = [m[np.lexsort(m.T[::-1])] for m in models]
    return [(m, cost / UNIT) for m, (_, _, cost) in zip(models, tallies(points, models))]


def block_scores(number: int, rows: np.ndarray, labels: list, sizes: list, members: list) -> list[float]:
    """Per model the summed silhouettes of a block of the rows, of which ``STRIP`` at a time meet all rows."""
    scores, end = [0.0] * len(labels), min((number + 1) * BLOCK, len(rows))
    for start in range(number * BLOCK, end, STRIP):
        at = slice(start, min(start + STRIP, end))
        apart = distances(rows[at], rows)
        np.sqrt(apart, out=apart)
        for model, (label, size, member) in enumerate(zip(labels, sizes, members)):
            sums, own = apart @ member, label[at]
            inside = np.arange(len(own))
            a = sums[inside, own] / np.maximum(size[own] - 1, 1)
            means = np.where(size > 0, sums / np.maximum(size, 1), np.inf)
            means[inside, own] = np.inf
            b = means.min(axis=1)
            with np.errstate(all="ignore"):
                score = np.where((size[own] > 1) & (np.maximum(a, b) > 0), (b - a) / np.maximum(a, b), 0.0)
            scores[model] += float(score.sum())
    return scores


def silhouettes(points: DataFrame, models: list[np.ndarray], seed: int, sample: int = SILHOUETTE_SAMPLE) -> list[float | None]:
    """Mean silhouette of each model by Euclidean distance, over at most ``sample`` rows, those with the smallest
    key hashes: each of them against all of them.  The sample is the one thing that travels whole, and its size is
    the parameter.  A row alone in its cluster counts as 0; a model with one cluster has none."""
    if not models:
        return []
    rows = drawn(points, seed, sample)
    labels = [distances(rows, m).argmin(axis=1) for m in models]
    sizes = [np.bincount(x, minlength=len(m)) for x, m in zip(labels, models)]
    spark = points.sparkSession
    shared = spark.sparkContext.broadcast((rows, labels, sizes))
    blocks = -(-len(rows) // BLOCK)

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, sizes = shared.value
        members = [np.eye(len(size))[label] for label, size in zip(labels, sizes)]
        for batch in batches:
            for number in batch.column(0).to_pylist():
                scores = block_scores(number, rows, labels, sizes, members)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([scores], pa.list_(pa.float64()))], names=["block", "scores"]
                )

    done = spark.range(0, blocks, numPartitions=max(1, min(blocks, 4 * spark.sparkContext.defaultParallelism)))
    per_block = sorted(done.mapInArrow(block, "block long, scores array<double>").collect())
    shared.unpersist()
    return [
        round(sum(r.scores[i] for r in per_block) / len(rows), 9) if (size > 0).sum() > 1 else None for i, size in enumerate(sizes)
    ]


class CentresModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted model as a pipeline stage: scales the features and adds the number of the nearest centre, of equally
    near ones the first."""

    features = Param(Params._dummy(), "features", "feature columns")
    scale = Param(Params._dummy(), "scale", "mean and deviation of each feature")
    centres = Param(Params._dummy(), "centres", "centres in whole multiples of 1 / UNIT deviations")
    predictionCol = Param(Params._dummy(), "predictionCol", "column of the number of the nearest centre")

    @keyword_only
    def __init__(self, *, features=None, scale=None, centres=None, predictionCol=None):
        super().__init__()
        self._setDefault(predictionCol="cluster")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def clusterCenters(self) -> list[np.ndarray]:
        return [np.array(c) / UNIT for c in self.getOrDefault(self.centres)]

    def squared_distances(self) -> Column:
        """To every centre, in squared deviations."""
        point = scaled(self.getOrDefault(self.features), self.getOrDefault(self.scale))
        return F.array(*[away(point, c) / F.lit(float(UNIT) ** 2) for c in self.getOrDefault(self.centres)])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        apart = self.squared_distances()
        number = (F.array_position(apart, F.array_min(apart)) - 1).cast("int")
        return dataset.withColumn(self.getOrDefault(self.predictionCol), number)


def points_of(df: DataFrame, key: str, features: list[str]) -> tuple[list[tuple[float, float]], DataFrame]:
    """The features' moments and the written points (key, z)."""
    scale = moments(df, features)
    shared_dir(df.sparkSession)
    return scale, df.select(F.col(key).alias("key"), scaled(features, scale).alias("z")).checkpoint()
