"""Hard negatives by threshold joins against all pairs, and their SQL."""

import math
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from mercata.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, no int, dim string, score long, window int"


def whole(x):
    return math.floor(256 * Fraction(x))


def brute(rows, every=100):
    rows = [
        (i, [whole(x) for x in v], label) for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for anchor, v, label in rows:
        if anchor % every:
            continue
        scores = [(-sum(map(int.__mul__, v, w)), i, kind == label) for i, w, kind in rows if i != anchor and len(w) == len(v)]
        for p, positive, _ in sorted(s for s in scores if s[2])[:5]:
            window = sorted(s for s in scores if not s[2] and 30 * -p <= 100 * -s[0] <= 90 * -p)[:10]
            out += [(anchor, positive, rank, i, -p, -n) for rank, (n, i, _) in enumerate(window, 1)]
    return sorted(out)


def run(frame, rows, every=100):
    out = negatives.hard_negatives(frame([(i, v, label, 1, "d", 2, 3) for i, v, label in rows], SCHEMA), every)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def made(n, dim=20, labels=4, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    label = rng.integers(0, labels, n)
    data = (centres[label] + 1.2 * rng.normal(size=(n, dim))).round(3) / 3
    data[n // 2:n // 2 + n // 10] = data[3]  # copies: equal scores
    return [(i, [float(x) for x in v], int(k)) for i, v, k in zip(range(n), data, label)]


@pytest.mark.parametrize("blocks", [(16_384, 16_384), (40, 3)])
def test_windows_of_all_pairs(frame, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "ROWS_PER_BLOCK", blocks[0])
    monkeypatch.setattr(negatives, "ANCHORS_PER_BLOCK", blocks[1])
    rows = made(600)
    assert run(frame, rows, every=50) == brute(rows, 50)


def test_rows_that_take_no_part_and_wide_components(frame, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS_PER_BLOCK", 30)
    rows = made(120, dim=3, labels=2, seed=4)
    rows += [(300, None, 1), (400, [], 1), (500, [1.0, None, 2.0], 0), (600, [math.nan, 1.0, 2.0], 0), (700, [math.inf, 1.0, 1.0], 0)]
    rows += [(None, [9.0, 9.0, 9.0], 0), (800, [1.0, 1.0, 1.0], None), (900, [0.0, 0.0, 0.0], 1), (901, [0.0, 0.0, 0.0], 1)]
    rows += [(1000, [1.0, 1.0], 0), (1001, [1.0, 2.0], 0), (1002, [1.0, 0.4], 1)]  # another length
    rows += [(1100, [1.0, 2.0, 0.5], 5), (1101, [200.5, 3.0, -7.0], 5), (1102, [90.25, 40.0, 1.0], 6)]  # more than two bytes
    rows += [(1200, [1e10, 0.0, 1.0], 7), (1201, [0.5, 0.0, 3.0], 7), (1202, [0.25, 3.0, 3.0], 8), (1203, [-1e300, 1.0, 3.0], 8)]
    rows += [(1300, [0.7, 0.1, 0.2], 0)] * 2 + [(1301, [0.5, 0.5, 0.5], 1)] * 12
    assert run(frame, rows) == brute(rows)


def test_a_positive_beyond_long_is_an_error(frame):
    with pytest.raises(Exception, match="range of long"):
        run(frame, [(0, [1e18, 1.0], 1), (1, [1e18, 1.0], 1), (2, [1.0, 1.0], 2)])


def test_empty_table(frame):
    assert run(frame, []) == []
    assert run(frame, made(30)[1:]) == []  # no anchor


def table(rows):
    codes = [np.floor(np.array(v) * 256).astype("<i2").tobytes() for _, v, _ in rows]
    return pa.table({
        "no": [i for i, *_ in rows], "vec_id": [i for i, *_ in rows], "label": [k for *_, k in rows],
        "dim": [len(v) for _, v, _ in rows], "narrow": [True] * len(rows), "code": codes,
    })


def test_threshold_join_finds_what_reaches_and_prunes():
    rows = made(900, dim=40)
    block = negatives.Block(table(rows))
    exact = block.values @ block.values.T
    for share in (0.3, 0.7, 0.9):
        least = share * np.diag(exact)
        found = {
            (int(a), int(r)): int(s)
            for group in negatives.reaching(block, slice(0, 200), least, block, slice(0, 900)) for a, r, s in zip(*group)
        }
        want = {(a, r): int(exact[a, r]) for a in range(200) for r in range(900) if a != r and exact[a, r] >= least[a]}
        assert found == want


def test_index_leaves_out_what_cannot_reach(monkeypatch):
    seen = []
    einsum = np.einsum
    monkeypatch.setattr(negatives.np, "einsum", lambda *a: seen.append(len(a[1])) or einsum(*a))
    left = np.ones((1, 32))
    right = np.vstack([np.ones((5, 32)), np.full((2_000, 32), 0.1)])
    ends = [0, 8, 16, 24, 32]
    wide = np.zeros(2_005, bool)
    lengths = [negatives.rest_lengths(x, ends, wide[:len(x)]) for x in (left, right)]
    at_l, at_r, score = negatives.accumulated(left, np.array([16.0]), right, *lengths, ends)
    assert sorted(at_r.tolist()) == [0, 1, 2, 3, 4] and set(score.tolist()) == {32.0}
    assert max(seen) <= 5  # the short rows are in no list


def test_sql_agrees():
    rows = made(300, labels=10)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    # The query moves labels before it calls the operator, as the SQL does.
    moved = [(i, v, (k + 1) % 10 if i % 7 == 0 else k) for i, v, k in rows]
    assert sorted(con.execute(negatives.HARD_NEGATIVES_SQL).fetchall()) == brute(moved)
