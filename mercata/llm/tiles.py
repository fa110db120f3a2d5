"""Query pages against row pages of a vector table: approximations first, exact vectors after.

Vectors are written once as pages of compact codes that bound every inner product from both sides.
Only pages meet in tiles, each of bounded size on both sides; the exact vectors stay where they are.  A
query's k-th best lower bound over all tiles decides which of its pairs may be among its best, and for
these alone the exact vectors are read, in order of their bound, until no unread one can
reach the k-th result.  Both searches share this; how they code and bound differs.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercata.llm.support import blocks_of, hashed_block, stored

ROWS_PER_BLOCK = 8_192
QUERIES_PER_BLOCK = 2_048
QUERIES_AT_ONCE = 64  # queries whose bounds are held at a time inside a tile
READ_AT_ONCE = 32     # exact vectors read between two looks at the bounds

PAGE = "dim int, block int, no binary, vec_id binary, codes binary, marks binary"
PAIR = "query_id long, query long, vec_id long, row long, low double, high double"
PAIR_TYPES = pa.schema([(n, t) for n, t in zip(
    ("query_id", "query", "vec_id", "row", "low", "high"), [pa.int64()] * 4 + [pa.float64()] * 2)])


def usable(embeddings: DataFrame, nonzero: bool) -> DataFrame:
    """(no, vec_id, dim, vector) of the vectors that take part, numbered: with an id, not null or empty, all
    components finite, and for ``nonzero`` not all zero."""
    vector = F.col("embedding").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ok = F.col("vec_id").isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)
    if nonzero:
        ok = ok & F.exists(vector, lambda x: x != 0)
    return embeddings.filter(F.coalesce(ok, F.lit(False))).select(
        F.monotonically_increasing_id().alias("no"), F.col("vec_id").cast("long").alias("vec_id"),
        F.size(vector).alias("dim"), vector.alias("vector"),
    )


def findable(vectors: DataFrame, k: int) -> DataFrame:
    """The rows that can be among any query's ``k`` best.  Rows of equal vectors have equal scores, so the smallest
    ids go first: ``k`` rows of an id are enough, and ``2 * k`` of a vector, as a query leaves out its own id."""
    of_id = F.row_number().over(Window.partitionBy("vector", "vec_id").orderBy("no"))
    of_vector = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id", "no"))
    some = vectors.withColumn("place", of_id).filter(F.col("place") <= k)
    return some.withColumn("place", of_vector).filter(F.col("place") <= 2 * k).drop("place")


class Page:
    """One page of a written table of codes."""

    def __init__(self, table: pa.Table):
        page = table.slice(0, 1).to_pylist()[0]
        self.dim, self.codes, self.marks = page["dim"], page["codes"], page["marks"]
        self.no, self.vec_id = (np.frombuffer(page[n], "<i8") for n in ("no", "vec_id"))


def paged(vectors: DataFrame, blocks: int, code: Callable, label: str) -> DataFrame:
    """Write the vectors as pages; ``code(matrix)`` returns a page's codes and marks as bytes."""

    def page(table: pa.Table) -> pa.Table:
        no = table.column("no").to_numpy()
        order = np.argsort(no)
        exact = table.column("vector").combine_chunks().flatten().to_numpy().reshape(len(no), -1)[order]
        codes, marks = code(exact)
        ids = table.column("vec_id").to_numpy()[order]
        return pa.table({
            "dim": pa.array([exact.shape[1]], pa.int32()), "block": table.column("block").slice(0, 1),
            "no": [no[order].astype("<i8").tobytes()], "vec_id": [ids.astype("<i8").tobytes()], "codes": [codes], "marks": [marks],
        })

    placed = vectors.withColumn("block", hashed_block(blocks, F.col("no")))
    return stored(placed.groupBy("dim", "block").applyInArrow(page, PAGE), label)


def search(
    vectors: DataFrame, is_query: Column, k: int, label: str, code_rows: Callable, code_queries: Callable,
    bounds: Callable, exact: Callable, score: str,
) -> DataFrame:
    """The ``k`` best rows of each query over all tiles: (query_id, rank, vec_id, score).

    ``bounds(queries, rows)`` gets two pages and yields (slice of queries, low, high), the bounds of all
    products of these queries with the page's rows; ``exact(wanted, vectors)`` returns the exact scores of pairs.
    A row is never a neighbour of a query with its own id; vectors of different lengths are not compared.
    """
    queries = stored(vectors.filter(is_query), f"{label}-queries")
    rows = stored(findable(vectors, k), f"{label}-rows")
    row_blocks, query_blocks = blocks_of(rows.count(), ROWS_PER_BLOCK), blocks_of(queries.count(), QUERIES_PER_BLOCK)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = paged(queries, query_blocks, code_queries, f"{label}-query-pages").withColumnRenamed("block", "query_block")
    right = paged(rows, row_blocks, code_rows, f"{label}-pages").withColumnRenamed("block", "row_block")

    def tile(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return PAIR_TYPES.empty_table()
        return pa.table([pa.array(x, t.type) for x, t in zip(pairs(Page(queries), Page(rows), bounds, k), PAIR_TYPES)], schema=PAIR_TYPES)

    key = ["dim", "query_block", "row_block"]
    tiles = left.withColumn("row_block", each(row_blocks)).groupBy(*key).cogroup(
        right.withColumn("query_block", each(query_blocks)).groupBy(*key)
    )
    found = stored(tiles.applyInArrow(tile, PAIR), f"{label}-pairs")
    return merged(read(reaching(found, k), queries, rows, exact, k, score), k, score)


def pairs(queries: Page, rows: Page, bounds: Callable, k: int) -> tuple[np.ndarray, ...]:
    """Columns of the pairs of a tile whose upper bound reaches the query's k-th best lower bound in it."""
    parts = []
    with np.errstate(all="ignore"):
        for some, low, high in bounds(queries, rows):
            own = queries.vec_id[some][:, None] == rows.vec_id[None, :]
            low = np.where(own | np.isnan(low), -np.inf, low)   # products beyond double bound nothing
            high = np.where(np.isnan(high), np.inf, high)
            count = len(rows.no)
            certain = np.partition(low, count - k, axis=1)[:, count - k, None] if count > k else -np.inf
            i, j = np.nonzero((high >= certain) & ~own)
            parts.append((queries.vec_id[some][i], queries.no[some][i], rows.vec_id[j], rows.no[j], low[i, j], high[i, j]))
    return tuple(map(np.concatenate, zip(*parts)))


def reaching(found: DataFrame, k: int) -> DataFrame:
    """The pairs whose upper bound reaches the query's k-th best lower bound over all tiles."""
    by_low = Window.partitionBy("query_id").orderBy(F.col("low").desc())
    certain = (
        found.select("query_id", "low").withColumn("place", F.row_number().over(by_low))
        .filter(F.col("place") == k).select("query_id", F.col("low").alias("certain"))
    )
    near = found.join(certain, "query_id", "left")
    return near.filter(F.col("certain").isNull() | (F.col("high") >= F.col("certain"))).drop("low", "certain")


def read(near: DataFrame, queries: DataFrame, rows: DataFrame, exact: Callable, k: int, score: str) -> DataFrame:
    """Exact scores of the pairs, read in order of their bound while it reaches the k-th best score so far.  A
    query's pairs may lie in several partitions, each of which returns its ``k`` best."""
    wanted = queries.select(F.col("no").alias("query"), F.col("vector").alias("wanted"))
    vectors = rows.select(F.col("no").alias("row"), "dim", "vector")
    ordered = (
        near.join(wanted, "query").join(vectors, "row").select("query_id", "dim", "high", "vec_id", "wanted", "vector")
        .sortWithinPartitions("query_id", "dim", F.col("high").desc())
    )
    kind = pa.float64() if score == "double" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, vec, best = None, None, None
        for batch in batches:
            query, dim, high, ids = (batch.column(i).to_numpy() for i in range(4))
            ends = np.flatnonzero((np.diff(query) != 0) | (np.diff(dim) != 0)) + 1
            done = []
            for a, b in zip([0, *ends], [*ends, len(query)]):
                if a == b:
                    continue
                if key != (query[a], dim[a]):
                    if key:
                        done.append((np.full(len(vec), key[0]), vec, best))
                    key, vec, best = (query[a], dim[a]), ids[:0], np.zeros(0, kind.to_pandas_dtype())
                for at in range(a, b, READ_AT_ONCE):
                    if len(best) >= k and best[k - 1] > high[at]:
                        break
                    size = min(READ_AT_ONCE, b - at)
                    left, right = (batch.column(i).slice(at, size).flatten().to_numpy().reshape(size, -1) for i in (4, 5))
                    vec, best = np.concatenate([vec, ids[at:at + size]]), np.concatenate([best, exact(left, right)])
                    top = np.lexsort((vec, -best))[:k]
                    vec, best = vec[top], best[top]
            if done:
                yield listed(done)
        if key:
            yield listed([(np.full(len(vec), key[0]), vec, best)])

    def listed(done):
        arrays = [pa.array(np.concatenate(x), t) for x, t in zip(zip(*done), (pa.int64(), pa.int64(), kind))]
        return pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])

    return ordered.mapInArrow(run, f"query_id long, vec_id long, score {score}")


def merged(found: DataFrame, k: int, kind: str) -> DataFrame:
    """Merge the lists of a query in a heap of ``k``, reading them in query order."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = None
        current, heap = None, []

        def ranked():
            top = sorted(heap, reverse=True)
            return [(current, i + 1, -negative, score) for i, (score, negative) in enumerate(top)]

        for batch in batches:
            names = batch.schema.field("score").type
            out = []
            for query, vec, score in zip(*(batch.column(n).to_pylist() for n in ("query_id", "vec_id", "score"))):
                if query != current:
                    out += ranked()
                    current, heap = query, []
                item = (score, -vec)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                else:
                    heapq.heappushpop(heap, item)
            if out:
                yield ranks(out, names)
        if heap:
            yield ranks(ranked(), names)

    def ranks(rows, type_):
        query, rank, vec, score = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int64()), pa.array(rank, pa.int32()), pa.array(vec, pa.int64()), pa.array(score, type_)],
            names=["query_id", "rank", "vec_id", "score"],
        )

    return (
        found.repartition("query_id").sortWithinPartitions("query_id")
        .mapInArrow(merge, f"query_id long, rank int, vec_id long, score {kind}")
    )
