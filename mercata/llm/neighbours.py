"""Nearest neighbours by a block matrix join on int8 codes with error bounds.

Every vector is coded as int8 with its own scale.  The product of two codes is off by no more
than the products of the residuals' and the codes' lengths allow, so a tile's int8 products
give a range for every inner product.  Pairs whose range reaches the k-th best lower end over all tiles
are recomputed from the original vectors in double precision and merged by heaps; the rest cannot be
among the best.  Tiles are shipped codes only, a byte a component.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.llm import tiles

EVERY = 20
EXACT_FLOAT32 = (1 << 24) // (127 * 127)  # longest code whose products float32 sums without rounding


def coded(vectors: np.ndarray):
    """int8 codes, scales, lengths of the decoded vectors and of the residuals."""
    scale = np.abs(vectors).max(axis=1) / 127.0
    with np.errstate(all="ignore"):
        codes = np.rint(vectors / scale[:, None])
    codes = np.nan_to_num(codes).clip(-127, 127).astype(np.int8)
    decoded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(decoded, axis=1), np.linalg.norm(vectors - decoded, axis=1)


def paged(vectors: np.ndarray) -> tuple[bytes, bytes]:
    with np.errstate(all="ignore"):
        codes, scale, length, residual = coded(vectors)
    return codes.tobytes(), np.stack([scale, length, residual]).astype("<f8").tobytes()


def bounds(queries: tiles.Page, rows: tiles.Page):
    kind = np.float32 if rows.dim <= EXACT_FLOAT32 else np.float64
    code, code_r = (np.frombuffer(p.codes, np.int8).reshape(-1, p.dim).astype(kind) for p in (queries, rows))
    scale, length, residual = np.frombuffer(queries.marks, "<f8").reshape(3, -1)
    scale_r, length_r, residual_r = np.frombuffer(rows.marks, "<f8").reshape(3, -1)
    for at in range(0, len(queries.no), tiles.QUERIES_AT_ONCE):
        some = slice(at, at + tiles.QUERIES_AT_ONCE)
        product = (code[some] @ code_r.T) * scale[some, None] * scale_r[None, :]
        error = np.outer(residual[some], length_r + residual_r) + np.outer(length[some], residual_r)
        error = error * (1 + 1e-6) + 1e-6 * np.outer(length[some], length_r) + 1e-300
        yield some, product - error, product + error


def exact(wanted: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return np.cumsum(vectors * wanted, axis=1)[:, -1]  # added up in order of dimension


def nearest(embeddings: DataFrame, k: int = 20, every: int = EVERY) -> DataFrame:
    """The ``k`` nearest rows by inner product of each row whose vec_id is divisible by ``every``.

    Returns query_id, rank, vec_id, score (double).  Vectors null, empty, zero or holding null or
    non-finite components, and rows without an id, take no part.  Equal scores go to the smaller id.
    A query with fewer candidates gets them all; an empty table gives no rows.  A repeated id is
    compared with every row but those that carry its own id.  The result is exact: recall is 1.
    """
    vectors = tiles.usable(embeddings, nonzero=True)
    return tiles.search(vectors, F.col("vec_id") % every == 0, k, "codes", paged, paged, bounds, exact, "double")
