"""Neighbours and the vector-approximation file against brute force."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mercata.llm import neighbours, tiles, vafile

SCHEMA = "vec_id long, embedding array<float>, label int, dim int, row_block int, score string"


def vectors(n, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, dim)).astype(np.float32)
    data[n // 2:n // 2 + n // 10] = data[3]  # copies: equal scores
    return data


def brute(ids, data, every, k, whole=False):
    x = np.floor(256 * data.astype(float)) if whole else data.astype(float)
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            scores = np.cumsum(x * q, axis=1)[:, -1]
            others = [(-s, j) for s, j in zip(scores, ids) if j != i]
            out[i] = [(j, -s) for s, j in sorted(others)[:k]]
    return out


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("blocks", [(8192, 1024), (50, 3)])
def test_both_searches_are_exact(spark, frame, monkeypatch, blocks):
    monkeypatch.setattr(tiles, "ROWS_PER_BLOCK", blocks[0])
    monkeypatch.setattr(tiles, "QUERIES_PER_BLOCK", blocks[1])
    data = vectors(300)
    ids = list(range(300))
    df = frame([(i, [float(x) for x in v], 0, 1, 2, "s") for i, v in zip(ids, data)], SCHEMA)
    assert collected(neighbours.nearest(df)) == brute(ids, data, 20, 20)
    assert collected(vafile.top_k(df)) == brute(ids, data, 50, 5, whole=True)


def test_codes_bound_products():
    data = vectors(200, 64).astype(float) * np.logspace(-6, 6, 200)[:, None]
    code, scale, length, residual = neighbours.coded(data)
    product = (code.astype(float) @ code.T.astype(float)) * np.outer(scale, scale)
    error = np.outer(residual, length + residual) + np.outer(length, residual)
    assert (np.abs(product - data @ data.T) <= error * (1 + 1e-9) + 1e-9 * np.outer(length, length)).all()


def test_cells_bound_vectors():
    data = np.floor(256 * vectors(500, 5).astype(float))
    number, marks = vafile.cells(data)
    low, high = vafile.edges(number, marks)
    assert (low <= data).all() and (data <= high).all()
    assert (vafile.unpacked(vafile.packed(number), 5) == number).all()
    assert len(vafile.packed(number)) == 500 * 4  # 30 bits a vector


@pytest.mark.parametrize("search, scale", [(vafile, 1), (vafile, 1e300), (neighbours, 1), (neighbours, 1e-200)])
def test_page_bounds_hold_and_prune(search, scale):
    data = vectors(400, 16).astype(float) * scale
    paged = getattr(search, "paged_rows", None) or search.paged
    asked = getattr(search, "paged_queries", None) or search.paged
    ids = np.arange(400)
    page = lambda code, x, no: tiles.Page(pa.table({
        "dim": [16], "no": [no.tobytes()], "vec_id": [no.tobytes()], "codes": [code(x)[0]], "marks": [code(x)[1]]}))
    queries, rows = page(asked, data[::20], ids[::20]), page(paged, data, ids)
    exact = vafile.whole(data) if search is vafile else data
    with np.errstate(all="ignore"):
        score = exact[::20] @ exact.T
        for some, low, high in search.bounds(queries, rows):
            assert not (low > score[some]).any() and not (high < score[some]).any()
    kept = tiles.pairs(queries, rows, search.bounds, 5)
    best = {i: {j for j in np.argsort(-np.where(ids == i, -np.inf, s), kind="stable")[:5]} for i, s in zip(ids[::20], score)}
    found = {}
    for i, j in zip(kept[0], kept[2]):
        found.setdefault(i, set()).add(j)
    if np.isfinite(score).all():
        assert all(best[i] <= found[i] for i in best)
    if scale == 1:
        assert len(kept[0]) < 20 * 400 / 2


def test_copies_of_a_vector_and_of_an_id(spark, frame, monkeypatch):
    """A third of all rows are one vector, a fifth one id: pairs stay few, results whole."""
    data, ids = vectors(300), np.arange(300)
    data[100:200], ids[200:260] = data[0], 0
    df = frame([(int(i), [float(x) for x in v], 0, 1, 2, "s") for i, v in zip(ids, data)], SCHEMA)
    for search, every, k, whole in ((neighbours.nearest, 20, 20, False), (vafile.top_k, 50, 5, True)):
        x = np.floor(256 * data.astype(float)) if whole else data.astype(float)
        expected = {}
        for i in sorted({int(i) for i in ids if i % every == 0}):
            scores = [(-s, int(j)) for q in x[ids == i] for s, j in zip(np.cumsum(x * q, axis=1)[:, -1], ids) if j != i]
            expected[i] = [(j, -s) for s, j in sorted(scores)[:k]]
        assert collected(search(df)) == expected
    assert tiles.findable(tiles.usable(df, False), 5).filter(F.col("vector") == F.array(*[F.lit(float(v)) for v in data[0]])).count() <= 10


def test_components_of_any_size(spark, frame):
    rows = [(0, [1e300, 2.0**40]), (1, [0.0, 2.0**-8]), (2, [0.0, 3.5]), (3, [0.0, -1.0]), (50, [0.0, 2.0**10 + 0.001])]
    df = frame([(i, v, 0, 1, 2, "s") for i, v in rows], SCHEMA.replace("float", "double"))
    got = collected(vafile.top_k(df.filter("vec_id <> 50")))
    assert got == {0: [(2, 2**48 * 896), (1, 2**48), (3, -(2**48) * 256)]}
    big = frame([(50, [2.0**20, 1.0], 0, 1, 2, "s"), (1, [2.0**26, 0.5], 0, 1, 2, "s"), (2, [2.0**26, -0.5], 0, 1, 2, "s")],
                SCHEMA.replace("float", "double"))
    assert collected(vafile.top_k(big)) == {50: [(1, 2**62 + 2**15), (2, 2**62 - 2**15)]}


def test_vectors_that_take_no_part(spark, frame):
    rows = [
        (0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, []), (80, [1.0, None]), (100, [math.nan, 1.0]), (120, [math.inf, 1.0]),
        (None, [1.0, 1.0]), (7, [0.5, 0.0]), (8, [0.5, 0.0]), (9, [1.0, 2.0, 3.0]), (10, [-1.0, 0.0]), (10, [-1.0, 0.0]),
    ]
    df = frame([(i, v, 0, 1, 2, "s") for i, v in rows], SCHEMA)
    assert collected(neighbours.nearest(df)) == {0: [(7, 0.5), (8, 0.5), (10, -1.0), (10, -1.0)]}
    got = collected(vafile.top_k(df))
    assert got == {0: [(7, 32768), (8, 32768), (20, 0), (10, -65536), (10, -65536)], 100: []} or got == {
        0: [(7, 32768), (8, 32768), (20, 0), (10, -65536), (10, -65536)]
    }


def test_empty_and_single(spark, frame):
    for rows in ([], [(0, [1.0], 0, 1, 2, "s")], [(3, [1.0], 0, 1, 2, "s"), (4, [1.0], 0, 1, 2, "s")]):
        df = frame(rows, SCHEMA)
        assert neighbours.nearest(df).collect() == [] and vafile.top_k(df).collect() == []


def test_too_large_components_raise(spark, frame):
    df = frame([(0, [1e30], 0, 1, 2, "s"), (1, [1.0], 0, 1, 2, "s")], SCHEMA)
    with pytest.raises(Exception, match="too large"):
        vafile.top_k(df).collect()
