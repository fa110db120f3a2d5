import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mercata.operators import ranks as R

BLOCK = 1 << R.BLOCK_BITS


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, a third of those on one value, values in many blocks."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(900):
        group = "hot" if i % 3 == 0 else f"g{i % 7}"
        if i % 9 == 0:
            value = 5
        else:
            value = int(rng.integers(-3 * BLOCK, 40 * BLOCK)) if i % 2 else int(rng.integers(0, 30))
        rows.append((f"k{i}", None if i % 50 == 1 else group, None if i % 41 == 2 else value))
    pdf = pd.DataFrame(rows, columns=["key", "grp", "value"])
    pdf["value"] = pdf["value"].astype("Int64")
    return spark.createDataFrame(rows, "key string, grp string, value long"), pdf


def groups(pdf):
    return pdf.groupby("grp", dropna=False)


def test_counts_before(skewed):
    df, pdf = skewed
    got = {(r.grp, r.value): r for r in R.counts_before(df, ["grp"], "value").collect()}
    for grp, part in groups(pdf):
        grp = None if pd.isna(grp) else grp
        vals = part["value"].fillna(R.NULL_RANK).astype("int64")
        for v in set(vals):
            r = got[(grp, v)]
            known = vals[(vals < v) & (vals < R.NULL_RANK)]
            assert (r.n, r.n_before, r.n_total) == ((vals == v).sum(), (vals < v).sum(), len(vals))
            assert r.v_before == known.sum()


def test_quantiles_match_linear_interpolation(skewed):
    df, pdf = skewed
    specs = {f"q{int(q * 100)}": ("value", q, None, 1) for q in (0, 0.05, 0.25, 0.5, 0.9, 1)}
    for r in R.quantiles(df, ["grp"], specs).collect():
        part = pdf[pdf.grp.isna()] if r.grp is None else pdf[pdf.grp == r.grp]
        vals = part["value"].dropna().astype(float).to_numpy()
        for name, (_, q, _, _) in specs.items():
            assert r[name] == pytest.approx(np.quantile(vals, q), rel=1e-12)


def test_quantiles_of_the_whole_table_and_of_nothing(skewed, frame):
    df, pdf = skewed
    one = R.quantiles(df, [], {"m": ("value", 0.5, None, 1)}).first()
    assert one.m == pytest.approx(pdf["value"].dropna().astype(float).median())
    empty = frame([("a", None)], "grp string, value long")
    agg = empty.groupBy("grp").count()
    assert R.with_quantiles(agg, empty, ["grp"], {"m": ("value", 0.5, 1, 1)}).first().m is None


def test_percent_rank_agrees_with_the_window(spark, skewed):
    df, _ = skewed
    got = R.percent_rank_in(df, ["grp"], {"r": "value"})
    df.createOrReplaceTempView("skewed")
    want = spark.sql(
        "SELECT key, percent_rank() OVER (PARTITION BY grp ORDER BY value ASC NULLS LAST) AS r FROM skewed"
    )
    assert {r.key: r.r for r in got.collect()} == {r.key: r.r for r in want.collect()}


@pytest.mark.parametrize("n", [4, 7])
def test_ntile_agrees_with_the_window(spark, skewed, n):
    df, _ = skewed
    got = R.ntile_in(df, ["grp"], "value", n, "key", "t")
    df.createOrReplaceTempView("skewed")
    want = spark.sql(
        f"SELECT key, ntile({n}) OVER (PARTITION BY grp ORDER BY value ASC NULLS LAST, md5(key), key) AS t FROM skewed"
    )
    assert {r.key: r.t for r in got.collect()} == {r.key: r.t for r in want.collect()}


def test_ntile_with_fewer_rows_than_tiles(frame):
    df = frame([("a", 1), ("b", 2)], "key string, v long")
    assert {r.key: r.t for r in R.ntile_in(df, [], "v", 4, "key", "t").collect()} == {"a": 1, "b": 2}


def test_concentration_curve_and_summary(skewed, frame):
    rows = [(f"s{i}", v) for i, v in enumerate([500, 0, 300, 300, 0, 100, 300, 0])]
    df = frame(rows, "store string, cents long")
    order = sorted(rows, key=lambda r: (-r[1], hashlib.md5(r[0].encode()).hexdigest()))
    running = np.cumsum([v for _, v in order])
    got = {r.store: r for r in R.concentration_curve(df, "cents", "store").collect()}
    for i, (store, _) in enumerate(order):
        assert (got[store].rank, got[store].cumulative) == (i + 1, running[i] / 100)
        assert got[store].cum_pct_total == pytest.approx(running[i] / 15)
    s = R.concentration_summary(df, "cents").first()
    for share in (50, 80, 90):
        assert s[f"rows_for_{share}pct"] == sum(running * 100 <= share * 1500)
    assert s.top_1pct_share == 33.3


def test_percentile_position_agrees_with_the_rank(skewed):
    df, _ = skewed
    want = {r.key: r.r for r in R.percent_rank_in(df, ["grp"], {"r": "value"}).collect()}
    keys = ["k0", "k3", "k2", "k1", "k43"]
    got = R.percentile_position(df, "grp", "key", keys, {"r": "value"}).collect()
    assert {r.key: r.r for r in got} == {k: want[k] for k in keys}


def test_few_rows_are_placed_as_many_are(frame, monkeypatch):
    """Null groups and values, repeated rows, a row alone, and an id that is not there."""
    rows = [("a", "g", 3, 1), ("a", "g", 3, 1), ("b", "g", None, 2), ("c", "g", 1, None), ("d", None, 5, 5), ("e", None, None, 1), ("f", "h", 2, 2)]
    df = frame(rows, "key string, grp string, v long, w long")
    cols, keys = {"x": "v", "y": "w", "z": "v"}, ["a", "b", "d", "e", "f", "none"]
    got = sorted(map(tuple, R.percentile_position(df, "grp", "key", keys, cols).collect()), key=repr)
    monkeypatch.setattr(R, "FEW_WANTED", 0)
    many = sorted(map(tuple, R.percentile_position(df, "grp", "key", keys, cols).collect()), key=repr)
    assert got == many and len(got) == 6 and ("f", "h", 0.0, 0.0, 0.0) in got
    assert R.percentile_position(df, "grp", "key", ["none"], cols).count() == 0


def test_quantile_buckets_match_qcut(frame):
    values = [0] * 30 + [1] * 5 + list(range(2, 40))
    df = frame([(v,) for v in values], "v long")
    got = sorted((r.v, r.bucket) for r in R.quantile_buckets(df, "v", 5).collect())
    want = sorted(zip(values, pd.qcut(values, 5, duplicates="drop").codes + 1))
    assert got == want


def test_majority_and_ties(frame):
    df = frame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "p"), ("b", "q")], "g string, l string")
    got = {r.g: (r.l, r.cnt, r.pct) for r in R.majority(df, ["g"], "l").collect()}
    assert got == {"a": ("x", 2, 66.7), "b": ("q", 1, 50.0)}


def test_argmax_share_and_change(frame):
    df = frame([("a", "x", 1), ("a", "y", 3), ("b", "x", None), ("b", "z", 2)], "g string, l string, v long")
    assert {r.g: r.l for r in R.argmax_row(df, ["g"], "v", "l").collect()} == {"a": "y", "b": "z"}
    shares = {(r.g, r.l): r.share_pct for r in R.share_of_group(df, ["g"], "v").collect()}
    assert shares[("a", "y")] == 75.0 and shares[("b", "x")] is None
    years = frame([("a", 1, 0), ("a", 2, 10), ("a", 3, 15)], "g string, y int, v long")
    got = [r.change_pct for r in R.pct_change(years, ["g"], "y", "v").orderBy("y").collect()]
    assert got == [None, None, 50.0]


@pytest.mark.parametrize("hot_rows", [0, 3, 40, 200])
def test_hot_cells_give_the_same_ranks(spark, skewed, monkeypatch, hot_rows):
    """Cut every cell, many cells or few: ranks, positions and sums stay the same."""
    df, _ = skewed
    want = {r.key: r for r in R.placed(df, ["grp"], "value", "key").collect()}
    monkeypatch.setattr(R, "HOT_ROWS", hot_rows)
    got = {r.key: r for r in R.placed(df, ["grp"], "value", "key").collect()}
    assert got == want
    down = {r.key: (r.position, r.v_upto) for r in R.placed(df, ["grp"], "value", "key", True).collect()}
    df.createOrReplaceTempView("skewed")
    sql = spark.sql(
        "SELECT key, row_number() OVER w - 1 AS position, coalesce(sum(value) OVER w, 0) AS v_upto FROM skewed "
        "WINDOW w AS (PARTITION BY grp ORDER BY value DESC NULLS LAST, md5(key), key "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    assert down == {r.key: (r.position, r.v_upto) for r in sql.collect()}


def test_hot_rows_are_split_between_tasks(spark, monkeypatch):
    """With one value holding all rows, the rank window is partitioned by digest as well."""
    monkeypatch.setattr(R, "HOT_ROWS", 100)
    df = spark.range(5000).select(F.col("id").cast("string").alias("key"), F.lit(1).alias("v"))
    got = R.placed(df, [], "v", "key")
    assert sorted(r.position for r in got.collect()) == list(range(5000))
    assert "_bucket" in got._jdf.queryExecution().optimizedPlan().toString()


def test_null_safe_join_keeps_null_groups(frame):
    left = frame([("a", 1), (None, 2)], "g string, x int")
    right = frame([("a", 10), (None, 20)], "g string, y int")
    got = sorted((r.x, r.y) for r in R.null_safe_join(left, right, ["g"]).collect())
    assert got == [(1, 10), (2, 20)]


def test_quantiles_over_columns_with_different_nulls(frame):
    df = frame([("a", 1, None), ("a", 3, 10), ("a", None, 20)], "g string, x long, y long")
    r = R.quantiles(df, ["g"], {"mx": ("x", 0.5, None, 1), "my": ("y", 0.5, None, 1)}).first()
    assert (r.mx, r.my) == (2.0, 15.0)


def test_any_number_of_keys_in_one_group(spark):
    df = spark.range(6000).select(F.col("id").cast("string").alias("key"), F.lit("g").alias("grp"), (F.col("id") * 7 % 601).alias("v"))
    keys = [str(i) for i in range(5000)]
    got = {r.key: r.r for r in R.percentile_position(df, "grp", "key", keys, {"r": "v"}).collect()}
    want = {r.key: r.r for r in R.percent_rank_in(df, ["grp"], {"r": "v"}).collect()}
    assert got == {k: want[k] for k in keys}


def test_prefix_over_very_large_names(frame):
    """Names beyond 2**40 fall into blocks of blocks."""
    names = [5, 1 << 21, 1 << 41, (1 << 41) + 1, 1 << 60, (1 << 62)]
    df = frame([("g", n, 1, n % 7) for n in names], "g string, name long, n long, v long")
    rows = sorted(R.prefix_sums(df, ["g"], "name").collect(), key=lambda r: r.name)
    assert [r.n_before for r in rows] == list(range(6)) and all(r.n_total == 6 for r in rows)
    assert [r.v_before for r in rows] == [sum(n % 7 for n in names[:i]) for i in range(6)]


def test_medians_are_exact(frame):
    rng = np.random.default_rng(4)
    for n in (1, 2, 7, 200):
        values = [(float(a) * 1e-5, None if i % 3 == 1 else float(b)) for i, (a, b) in enumerate(rng.integers(-50, 50, (n, 2)))]
        got = R.medians(frame(values, "a double, b double"), {"ma": "a", "mb": "b"}).first()
        assert got.ma == np.median([a for a, _ in values])
        assert got.mb == np.median([b for _, b in values if b is not None])


def test_rows_are_shuffled_once_per_ranking_and_text_stays_behind(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(
        F.col("id").cast("string").alias("asin"), F.lit("s").alias("subcategory"), (F.col("id") % 97).alias("revenue_cents"),
        F.lit("long text").alias("description"),
    ).write.parquet(path)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = spark.read.parquet(path).select("asin", "subcategory", "revenue_cents")
        ranked = R.ntile_in(df, ["subcategory"], "revenue_cents", 4, "asin", "q")
        plan = ranked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    lines = plan.splitlines()
    top = next(i for i, line in enumerate(lines) if "SortMergeJoin [_k0" in line and "_bucket" in line)
    window = next(i for i, line in enumerate(lines) if i > top and "Window" in line)
    assert not any("Exchange" in line for line in lines[top:window])  # the join takes the window's partitioning
    assert "description" not in plan
