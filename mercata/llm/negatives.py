"""Hard negatives by threshold joins over a pruned inverted index.

A join finds the rows whose integer inner product with an anchor reaches the anchor's threshold.
Inside a tile, rows and dimensions are kept as an inverted index in chunks of dimensions: a row's
last chunks are left out of it where the lengths of its and of the anchors' rest show that they cannot lift
any score to its threshold.  Scores are accumulated chunk by chunk; pairs whose rest cannot lift them
to the threshold any more go, and what remains is summed up exactly.

Thresholds start from one block of the rows: for positives the k-th best there, which the k-th best
of all rows reaches for certain; for the windows of negatives a score there that about ten rows are expected to lie
above.  Windows that stay unfilled are joined again with lower thresholds, down to their lower end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercata.llm.support import blocks_of, hashed_block, stored

EVERY = 100
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90      # a window of negatives, per cent of the positive's score
GRID = 256
ROWS_PER_BLOCK = 16_384
ANCHORS_PER_BLOCK = 16_384
CHUNK = 8               # dimensions accumulated between two looks at the bounds
ANCHORS_AT_ONCE = 128
FEW = 1 / 16            # share of pairs below which they are followed one by one
LOWERED = 4             # a window's part above the threshold grows so many times with each further join
NARROW = 1 << 15        # components below it are shipped in two bytes
LEAST, MOST = -(1 << 63), (1 << 63) - 1  # whole scores beyond these count as these

VECTOR = "no long, vec_id long, label long, dim int, narrow boolean, code binary"


def usable(embeddings: DataFrame) -> DataFrame:
    """(no, vec_id, label, dim, narrow, code) of the rows that take part, written; ``code`` holds floor(256 * x) in two
    bytes where that is enough for all components of a vector, else x itself as double."""
    vector = F.col("embedding").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    rows = embeddings.filter(F.coalesce(ok, F.lit(False))).select(
        F.monotonically_increasing_id().alias("no"), vec_id.alias("vec_id"), label.alias("label"), vector.alias("vector")
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(3)
            ends, values = column.offsets.to_numpy(), column.values.to_numpy()
            codes, narrow = [], []
            for a, b in zip(ends[:-1], ends[1:]):
                x = values[a:b]
                if (np.abs(x) < NARROW / GRID).all():
                    codes.append(np.floor(x * GRID).astype("<i2").tobytes())
                else:
                    codes.append(x.astype("<f8").tobytes())
                narrow.append(len(codes[-1]) == 2 * (b - a))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.diff(ends), pa.int32()), pa.array(narrow, pa.bool_()), pa.array(codes, pa.binary())],
                names=["no", "vec_id", "label", "dim", "narrow", "code"],
            )

    return stored(rows.mapInArrow(code, VECTOR), "negatives-vectors")


class Block:
    """One side of a tile: vectors as doubles, in order of label, id and number, and which of them are wide."""

    def __init__(self, table: pa.Table):
        vec_id, label = table.column("vec_id").to_numpy(), table.column("label").to_numpy()
        order = np.lexsort((table.column("no").to_numpy(), vec_id, label))
        self.table, self.vec_id, self.label = table.take(pa.array(order)), vec_id[order], label[order]
        self.codes = self.table.column("code").to_pylist()
        self.wide = ~self.table.column("narrow").to_numpy()
        self.values = np.empty((len(self.codes), table.column("dim")[0].as_py()))
        for i, (wide, code) in enumerate(zip(self.wide.tolist(), self.codes)):
            with np.errstate(over="ignore"):
                self.values[i] = np.floor(np.frombuffer(code, "<f8") * GRID) if wide else np.frombuffer(code, "<i2")

    def labelled(self, label: int) -> slice:
        return slice(int(np.searchsorted(self.label, label, "left")), int(np.searchsorted(self.label, label, "right")))

    def whole(self, i: int) -> list[int]:
        """The components as whole numbers of any size: 256 x is one, or floors to one, exactly."""
        if not self.wide[i]:
            return np.frombuffer(self.codes[i], "<i2").tolist()
        parts = (x.as_integer_ratio() for x in np.frombuffer(self.codes[i], "<f8").tolist())
        return [above * GRID // below for above, below in parts]


def rest_lengths(values: np.ndarray, ends: list[int], wide: np.ndarray) -> np.ndarray:
    """Length of each vector's part from each chunk's start on, a little too long, with 0 at the end.  That of a
    wide vector is infinite: no bound leaves it out."""
    squares = [np.square(values[:, a:b]).sum(axis=1) for a, b in zip(ends[:-1], ends[1:])]
    rest = np.cumsum(np.stack([*squares, np.zeros(len(values))], axis=1)[:, ::-1], axis=1)[:, ::-1]
    rest = np.sqrt(rest) * (1 + 1e-9)
    rest[wide] = np.inf
    return rest


def reaching(anchors: Block, a: slice, least: np.ndarray, rows: Block, r: slice):
    """(anchor, row, score) arrays of the pairs of two parts of blocks whose score may reach the anchor's ``least``;
    pairs of narrow vectors reach it and carry their exact score.  Pairs of one vec_id are left out."""
    left, right, least = anchors.values[a], rows.values[r], least[a]
    if not len(left) or not len(right):
        return
    with np.errstate(all="ignore"):
        by_weight = np.argsort(-np.square(right).sum(axis=0), kind="stable")
        left, right = left[:, by_weight], right[:, by_weight]
        ends = [*range(0, right.shape[1], CHUNK), right.shape[1]]
        rest_l, rest_r = rest_lengths(left, ends, anchors.wide[a]), rest_lengths(right, ends, rows.wide[r])
        groups = -(-len(left) // ANCHORS_AT_ONCE)
        for some in np.array_split(np.argsort(least / rest_l[:, 0], kind="stable"), groups):
            at_l, at_r, score = accumulated(left[some], least[some], right, rest_l[some], rest_r, ends)
            yield scored(anchors, some[at_l] + a.start, rows, at_r + r.start, score)


def accumulated(left, least, right, rest_l, rest_r, ends):
    """The pairs that reach their threshold, by an inverted index in chunks of dimensions."""
    chunks = len(ends) - 1
    # A row's chunks from the first on that cannot lift any score to its threshold are left out of the lists.
    reach = (rest_l / least[:, None]).max(axis=0) if (least > 0).all() else np.full(chunks + 1, np.inf)
    indexed = np.minimum((~(reach * rest_r < 1)).sum(axis=1), chunks)
    order = np.argsort(-indexed, kind="stable")[:int((indexed > 0).sum())]
    right, rest_r, indexed = right[order], rest_r[order], indexed[order]
    partial, alive = np.zeros((len(left), len(right))), np.ones((len(left), len(right)), bool)
    seen = 0
    while seen < chunks and (seen == 0 or alive.sum() > FEW * alive.size):
        listed = int(np.searchsorted(-indexed, -seen, "left"))  # rows that have the chunk in its lists
        if not listed:
            break
        a, b = ends[seen], ends[seen + 1]
        seen += 1
        partial[:, :listed] += left[:, a:b] @ right[:listed, a:b].T
        bound = partial[:, :listed] + rest_l[:, seen, None] * rest_r[None, :listed, seen]
        alive[:, :listed] = ~(bound < least[:, None])
    at_l, at_r = np.nonzero(alive)
    score = partial[at_l, at_r]
    # The pairs that are left are followed one by one through the chunks that are not added up yet.
    for chunk in range(chunks):
        open_ = np.flatnonzero(chunk >= np.minimum(indexed[at_r], seen))
        a, b = ends[chunk], ends[chunk + 1]
        score[open_] += np.einsum("ij,ij->i", left[at_l[open_], a:b], right[at_r[open_], a:b])
        bound = score[open_] + rest_l[at_l[open_], chunk + 1] * rest_r[at_r[open_], chunk + 1]
        kept = np.ones(len(score), bool)
        kept[open_] = ~(bound < least[at_l[open_]])
        at_l, at_r, score = at_l[kept], at_r[kept], score[kept]
    return at_l, order[at_r], score


def scored(anchors: Block, at_l: np.ndarray, rows: Block, at_r: np.ndarray, score: np.ndarray):
    """The pairs but those of one vec_id, with exact scores as longs."""
    other = anchors.vec_id[at_l] != rows.vec_id[at_r]
    at_l, at_r, score = at_l[other], at_r[other], score[other]
    wide = anchors.wide[at_l] | rows.wide[at_r]
    exact = np.where(wide, 0, score).astype(np.int64)
    for i in np.flatnonzero(wide).tolist():
        product = sum(x * y for x, y in zip(anchors.whole(at_l[i]), rows.whole(at_r[i])))
        exact[i] = min(max(product, LEAST), MOST)
    return at_l, at_r, exact


def first(score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids."""
    near = np.arange(len(score))
    if len(score) > 8 * k:
        near = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return near[np.lexsort((vec_id[near], ~score[near]))[:k]]  # ~ turns the order round for every long


def by_anchor(at_l: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of each anchor's pairs."""
    order = np.argsort(at_l, kind="stable")
    names, starts = np.unique(at_l[order], return_index=True)
    yield from zip(names.tolist(), np.split(order, starts[1:]))


FOUND = "no long, window int, vec_id long, score long"
FOUND_TYPES = pa.schema([("no", pa.int64()), ("window", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def found_table(found: list[tuple]) -> pa.Table:
    """Arrow table of (no, window, ids, scores) lists."""
    if not found:
        return FOUND_TYPES.empty_table()
    sizes = [len(x[2]) for x in found]
    columns = [np.repeat([x[0] for x in found], sizes), np.repeat([x[1] for x in found], sizes)]
    columns += [np.concatenate([x[i] for x in found]) for i in (2, 3)]
    return pa.table([pa.array(c, t.type) for c, t in zip(columns, FOUND_TYPES)], schema=FOUND_TYPES)


def best_positives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """Of a tile: the first rows of each anchor's own label that reach its threshold, if it has one."""
    out = []
    if anchors.num_rows and rows.num_rows:
        left, right = Block(anchors), Block(rows)
        numbers = left.table.column("no").to_pylist()
        least = np.array([-np.inf if t is None else float(t) for t in left.table.column("threshold").to_pylist()])
        for label in np.unique(left.label):
            for at_l, at_r, score in reaching(left, left.labelled(label), least, right, right.labelled(label)):
                for anchor, places in by_anchor(at_l):
                    top = places[first(score[places], right.vec_id[at_r[places]], POSITIVES)]
                    out.append((numbers[anchor], 0, right.vec_id[at_r[top]], score[top]))
    return found_table(out)


def ends_of(positive: int) -> tuple[int, int]:
    """Lowest and highest score of the window that belongs to a positive's score."""
    return -(-LOW * positive // 100), HIGH * positive // 100


def best_negatives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """Of a tile: for each open window of an anchor the first rows of other labels in it that reach the anchor's threshold."""
    out = []
    if anchors.num_rows and rows.num_rows:
        left, right = Block(anchors), Block(rows)
        numbers, windows = left.table.column("no").to_pylist(), left.table.column("windows").to_pylist()
        least = np.array([float(min(w["threshold"] for w in ws)) for ws in windows])
        for at_l, at_r, score in reaching(left, slice(0, len(numbers)), least, right, slice(0, rows.num_rows)):
            other = left.label[at_l] != right.label[at_r]
            at_l, at_r, score = at_l[other], at_r[other], score[other]
            for anchor, places in by_anchor(at_l):
                mine, vec_id = score[places], right.vec_id[at_r[places]]
                for w in windows[anchor]:
                    low, high = ends_of(w["score"])
                    inside = np.flatnonzero((mine >= low) & (mine <= high))
                    top = inside[first(mine[inside], vec_id[inside], NEGATIVES)]
                    out.append((numbers[anchor], w["window"], vec_id[top], mine[top]))
    return found_table(out)


def joined(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int], best, only: int | None = None) -> DataFrame:
    """``best`` of every tile of anchor and row blocks, or of those of one row block."""
    anchor_blocks, row_blocks = blocks
    rows = rows.withColumn("row_block", hashed_block(row_blocks, F.lit(1), F.col("no")))
    if only is not None:
        rows = rows.filter(F.col("row_block") == only)
    met = F.array(F.lit(only)) if only is not None else F.sequence(F.lit(0), F.lit(row_blocks - 1))
    left = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])  # columns of its own: it stems from ``rows``
    left = left.withColumn("anchor_block", hashed_block(anchor_blocks, F.lit(2), F.col("no")))
    left = left.withColumn("row_block", F.explode(met))
    right = rows.withColumn("anchor_block", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))))
    key = ["dim", "anchor_block", "row_block"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(best, FOUND)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` first of each window over all tiles, each of which has returned at most ``k``."""
    order = Window.partitionBy("no", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def positives(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int]) -> DataFrame:
    """(no, window, positive_id, score): each anchor's first rows of its own label."""
    unset = anchors.withColumn("threshold", F.lit(None).cast("long"))
    found = stored(joined(unset, rows, blocks, best_positives, only=0), "negatives-positives")
    if blocks[1] > 1:
        enough = F.when(F.count(F.lit(1)) >= POSITIVES, F.min("score"))
        reached = found.groupBy("no").agg(enough.alias("threshold"))
        found = joined(anchors.join(reached, "no", "left"), rows, blocks, best_positives)
    too_large = F.raise_error(F.lit("the score of a positive leaves the range of long")).cast("long")
    return stored(
        ranked(found, POSITIVES).select(
            "no", F.col("rank").alias("window"), F.col("vec_id").alias("positive_id"),
            F.when(F.col("score") < MOST, F.col("score")).otherwise(too_large).alias("score"),
        ),
        "negatives-positives",
    )


def low_end() -> Column:
    return F.ceil(F.col("score").cast("decimal(20,0)") * LOW / 100).cast("long")


def high_end() -> Column:
    return F.floor(F.col("score").cast("decimal(20,0)") * HIGH / 100).cast("long")


def lowered(threshold: Column) -> Column:
    """A lower threshold: the window's part above it grows ``LOWERED`` times, at most to the low end."""
    step = (high_end() - threshold + 1).cast("decimal(38,0)") * LOWERED
    return F.greatest(low_end().cast("decimal(38,0)"), high_end().cast("decimal(38,0)") - step).cast("long")


def hard_negatives(embeddings: DataFrame, every: int = EVERY) -> DataFrame:
    """For each anchor (vec_id divisible by ``every``) and each of its first ``POSITIVES`` rows of the same label, the first
    ``NEGATIVES`` rows of other labels whose score is ``LOW`` to ``HIGH`` per cent of the positive's.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.  A score is the inner
    product of the vectors of floor(256 * x); higher scores come first, ties by smaller vec_id.  Rows without vec_id, label or
    vector, with an empty vector or a null or non-finite component take no part; vectors of different lengths never
    meet, nor rows of one vec_id.  A repeated anchor is an anchor each time, a repeated row a positive or negative each
    time.  A positive with a negative score, or one that no row suits, has no rows.  An empty table gives none; other columns
    are ignored.  Products are exact whatever the components' size; one of a positive beyond long is an error.
    """
    rows = usable(embeddings)
    anchors = rows.filter(F.col("vec_id") % every == 0)
    blocks = blocks_of(anchors.count(), ANCHORS_PER_BLOCK), blocks_of(rows.count(), ROWS_PER_BLOCK)
    pairs = positives(anchors, rows, blocks)
    waiting, done, only = pairs.filter("score >= 0").withColumn("threshold", low_end()), [], 0
    while not waiting.isEmpty():
        open_windows = waiting.groupBy("no").agg(F.collect_list(F.struct("window", "score", "threshold")).alias("windows"))
        found = ranked(joined(anchors.join(open_windows, "no"), rows, blocks, best_negatives, only), NEGATIVES)
        found = stored(found, "negatives-found")
        wanted = NEGATIVES if only is None else -(-2 * NEGATIVES // blocks[1])
        state = found.filter(F.col("rank") <= wanted).groupBy("no", "window").agg(
            F.count(F.lit(1)).alias("n"), F.min("score").alias("last")
        )
        state = waiting.withColumn("reached", F.min("threshold").over(Window.partitionBy("no"))).join(state, ["no", "window"], "left")
        full = F.coalesce(F.col("n"), F.lit(0)) >= wanted
        if only is not None and blocks[1] > 1:
            state = state.withColumn("threshold", F.when(full, F.col("last")).otherwise(F.col("threshold")))
            waiting = stored(state.select(*pairs.columns, "threshold"), "negatives-open")
        else:
            closed = full | (F.col("reached") <= low_end()) if blocks[1] > 1 else F.lit(True)
            state = stored(state.withColumn("closed", closed), "negatives-open")
            done.append(found.join(state.filter("closed").select("no", "window"), ["no", "window"]))
            waiting = state.filter(~F.col("closed")).withColumn("threshold", lowered(F.col("reached"))).select(*pairs.columns, "threshold")
        only = None
    negatives = done[0] if done else None
    for more in done[1:]:
        negatives = negatives.unionByName(more)
    if negatives is None:
        negatives = rows.sparkSession.createDataFrame([], FOUND + ", rank int")
    names = anchors.select("no", F.col("vec_id").alias("anchor_id"))
    return (
        negatives.select("no", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(pairs.withColumnRenamed("score", "positive_score"), ["no", "window"]).join(names, "no")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike, CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id AND len(a.e) = len(r.e) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
