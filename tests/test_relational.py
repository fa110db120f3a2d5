import numpy as np
import pytest
from pyspark.sql import functions as F

from mercata.operators import relational as rel


def test_tokens_are_whole_runs(frame):
    df = frame([("It's GREAT-value, über 4k! a1b2 no",), ("",), (None,)], "t string")
    assert [r.word for r in rel.explode_tokens(df, "t").collect()] == [
        "it", "s", "great", "value", "ber", "4k", "a1b2", "no",
    ]
    assert [r.word for r in rel.explode_tokens(df, "t", min_length=3).collect()] == [
        "great", "value", "ber", "a1b2",
    ]


def test_scalars_come_without_a_join(frame):
    df = frame([(1,), (3,)], "v long")
    out = rel.with_scalars(df, lo=F.min("v"), hi=F.max("v"))
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1, 3), (3, 1, 3)]
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_top_k_and_extremes(frame):
    df = frame([("a", 1), ("b", 5), ("c", None), ("d", 3), ("e", 5)], "k string, v long")
    assert [r.k for r in rel.top_k(df, "v", 2, tiebreak=["k"]).collect()] == ["b", "e"]
    assert [r.k for r in rel.top_k(df, "v", 9, asc=True, tiebreak=["k"]).collect()] == ["a", "d", "b", "e"]
    assert sorted(r.k for r in rel.extremes(df, "v", 1, ["k"]).collect()) == ["a", "b"]


def test_sort_puts_nulls_last_both_ways(frame):
    df = frame([(None,), (2,), (1,)], "v long")
    assert [r.v for r in rel.sort(df, "v").collect()] == [1, 2, None]
    assert [r.v for r in rel.sort(df, "-v").collect()] == [2, 1, None]


def test_sort_by_label(frame):
    df = frame([("Deep",), ("Other",), ("None",), ("Light",)], "t string")
    assert [r.t for r in rel.sort_by_label(df, "t", ["None", "Light", "Deep"]).collect()] == [
        "None", "Light", "Deep", "Other",
    ]


def test_samples_repeat(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    once = {r.k for r in rel.sample_rows(df, 10, "k").collect()}
    again = {r.k for r in rel.sample_rows(df.repartition(7), 10, "k").collect()}
    assert once == again and 400 < len(once) < 600
    assert {r.k for r in rel.sample_rows(df, 10, "k", seed=1).collect()} != once
    n = rel.sample_n(df, 100, "k")
    assert n.count() == 100 and {r.k for r in n.collect()} == {r.k for r in rel.sample_n(df.repartition(5), 100, "k").collect()}
    assert rel.sample_n(df, 9000, "k").count() == 5000
    assert rel.sample_rows(df, 100, "k").count() == 5000


def test_rows_of_top_groups_and_crosstab(frame):
    df = frame([("a", "x", 1), ("a", "y", 1), ("b", "x", 5), ("c", "x", 9)], "g string, l string, v long")
    assert {r.g for r in rel.rows_of_top_groups(df, "g", F.sum("v"), 2).collect()} == {"b", "c"}
    pct = {(r.g, r.l): r.pct for r in rel.crosstab_pct(df, "g", "l").collect()}
    assert pct == {("a", "x"): 50.0, ("a", "y"): 50.0, ("b", "x"): 100.0, ("c", "x"): 100.0}


def test_corr_matrix(frame):
    rows = [(1, 2.0, 9.0), (2, 4.0, 1.0), (3, 6.5, 4.0), (4, 7.0, 2.0)]
    got = {(r.a, r.b): r["corr"] for r in rel.corr_matrix(frame(rows, "x int, y double, z double"), ["x", "y", "z"]).collect()}
    want = np.corrcoef(np.array(rows, float).T)
    for i, a in enumerate("xyz"):
        for j, b in enumerate("xyz"):
            assert got[(a, b)] == pytest.approx(want[i, j], abs=1e-6)


def test_histogram_closes_the_last_bin(frame):
    df = frame([(v,) for v in (0, 1, 5, 9, 10, None)], "v long")
    got = {r.bin: r.n for r in rel.histogram(df, "v", 5).collect()}
    assert got == {0: 2, 2: 1, 4: 2}
    assert [r.n for r in rel.histogram(frame([(3,), (3,)], "v long"), "v", 5).collect()] == [2]


def test_describe_counts_nulls(frame):
    r = rel.describe(frame([(1,), (3,), (None,)], "v long"), ["v"]).first()
    assert (r.non_null, r.nulls, r["mean"], r["min"], r["max"]) == (2.0, 1.0, 2.0, 1.0, 3.0)


def test_trim_upper_keeps_the_bound(frame):
    df = frame([(v,) for v in range(1, 101)], "v long")
    assert rel.trim_upper(df, ["v"], 0.95).count() == 95


def test_semi_join_and_pivot(frame):
    ids = frame([("a",), ("a",)], "asin string")
    df = frame([("a", "p", 1), ("b", "p", 2), ("a", "q", 3)], "parent_asin string, l string, v long")
    assert rel.only_known(df, ids, "parent_asin").count() == 2
    wide = {r.parent_asin: (r.p, r.q) for r in rel.pivot_labels(df, "parent_asin", "l", {"p": "p", "q": "q"}, "v").collect()}
    assert wide == {"a": (1, 3), "b": (2, None)}
