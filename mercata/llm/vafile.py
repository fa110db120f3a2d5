"""Exact top-k search over a vector-approximation file.

The file holds pages of packed cell numbers, ``BITS`` a component, and the marks between the cells: in
each dimension of a page, ``2**BITS`` cells of about equally many vectors.  A scan of the cells
alone bounds every score from both sides.  Exact vectors are then read in order of their bound until no
unread one can reach the k-th result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.llm import tiles

EVERY = 50
BITS = 6
GRID = 256
MOST = (1 << 63) - 1  # whole scores beyond this size count as this


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x) as doubles; exact unless beyond double, then infinite."""
    with np.errstate(over="ignore"):
        return np.floor(vectors * GRID)


def cells(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell numbers of the vectors, and the marks between cells: one row more than cells, from the least
    component of a dimension to the largest."""
    places = np.linspace(0, 1, (1 << BITS) + 1)
    marks = np.quantile(vectors, places, axis=0, method="lower")
    number = [np.searchsorted(m[1:-1], x, side="right") for m, x in zip(marks.T, vectors.T)]
    return np.stack(number, axis=1).astype(np.uint8), marks


def packed(number: np.ndarray) -> bytes:
    bits = (number[:, :, None] >> np.arange(BITS - 1, -1, -1, dtype=np.uint8)) & 1
    return np.packbits(bits.reshape(len(number), -1), axis=1).tobytes()


def unpacked(codes: bytes, dim: int) -> np.ndarray:
    table = np.frombuffer(codes, np.uint8).reshape(-1, -(-dim * BITS // 8))
    bits = np.unpackbits(table, axis=1, count=dim * BITS).reshape(len(table), dim, BITS)
    return bits @ (1 << np.arange(BITS - 1, -1, -1)).astype(np.uint8)


def edges(number: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper edge of every component's cell."""
    dims = np.arange(number.shape[1])
    return marks[number, dims], marks[number + 1, dims]


def paged_rows(vectors: np.ndarray) -> tuple[bytes, bytes]:
    number, marks = cells(whole(vectors))
    return packed(number), marks.astype("<f8").tobytes()


def paged_queries(vectors: np.ndarray) -> tuple[bytes, bytes]:
    return whole(vectors).astype("<f8").tobytes(), b""


def bounds(queries: tiles.Page, rows: tiles.Page):
    wanted = np.frombuffer(queries.codes, "<f8").reshape(-1, queries.dim)
    low, high = edges(unpacked(rows.codes, rows.dim), np.frombuffer(rows.marks, "<f8").reshape(-1, rows.dim))
    middle = (low + high) / 2
    reach = (high - low) / 2 + 1e-9 * (np.abs(low) + np.abs(high))  # the last for rounding in the sums
    for at in range(0, len(wanted), tiles.QUERIES_AT_ONCE):
        some = slice(at, at + tiles.QUERIES_AT_ONCE)
        score, error = wanted[some] @ middle.T, np.abs(wanted[some]) @ reach.T
        yield some, score - error, score + error


def exact(wanted: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Whole scores of any size, those beyond a long as ``MOST``."""
    a, b = whole(wanted), whole(vectors)
    with np.errstate(all="ignore"):
        wide = ~((np.abs(a) * np.abs(b)).sum(axis=1) < 2.0**62)
        score = (np.where(wide[:, None], 0, a).astype(np.int64) * np.where(wide[:, None], 0, b).astype(np.int64)).sum(axis=1)
    for i in np.flatnonzero(wide):
        product = sum(x * y for x, y in zip(numbers(wanted[i]), numbers(vectors[i])))
        score[i] = max(-MOST, min(MOST, product))
    return score


def numbers(vector: np.ndarray) -> list[int]:
    """floor(256 * x) as whole numbers of any size."""
    parts = (x.as_integer_ratio() for x in vector.tolist())
    return [above * GRID // below for above, below in parts]


def top_k(embeddings: DataFrame, k: int = 5, every: int = EVERY) -> DataFrame:
    """The ``k`` highest integer inner products of each row whose vec_id is divisible by ``every``,
    components taken as floor(256 * x).

    Returns query_id, rank, vec_id, score (long).  Vectors null, empty or holding null or non-finite
    components, and rows without an id, take no part; zero vectors do.  Equal scores go to the smaller
    id.  A query with fewer candidates gets them all; an empty table gives no rows.  A repeated id is
    compared with every row but those that carry its own id.  Components may have any finite size;
    a returned score that no long holds raises an error.
    """
    vectors = tiles.usable(embeddings, nonzero=False)
    found = tiles.search(vectors, F.col("vec_id") % every == 0, k, "cells", paged_rows, paged_queries, bounds, exact, "long")
    fits = F.when(F.abs("score") < MOST, F.col("score"))
    return found.withColumn("score", fits.otherwise(F.raise_error(F.lit("a score is too large for a long")).cast("long")))
