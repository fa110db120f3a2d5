"""Reshaping, set operations, ordering, sampling and scalar joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.functions.exact import col, half_up


# ---- joins ----------------------------------------------------------------

def only_known(df: DataFrame, ids: DataFrame, on: str, id_col: str = "asin") -> DataFrame:
    """Rows whose key appears among the ids (left semi; AQE broadcasts the ids
    when their measured size allows)."""
    return df.join(ids.select(F.col(id_col).alias(on)), on, "left_semi")


def add_single_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """Add the columns of a one-row table to every row, as a scalar subquery: it is
    worked out once and reaches the rows as a constant."""
    packed = one.select(F.struct(*one.columns).alias("_one"))
    out = df.withColumn("_one", packed.scalar())
    return out.select(*df.columns, "_one.*")


def with_scalars(df: DataFrame, **aggs: Column) -> DataFrame:
    """Add whole-table aggregates to every row."""
    return add_single_row(df, df.agg(*[a.alias(n) for n, a in aggs.items()]))


def share_of_total(df: DataFrame, measure: str, name: str, scale: int | None = None) -> DataFrame:
    """Measure as a percentage of the table's total."""
    out = with_scalars(df, _total=F.sum(measure))
    share = F.try_divide(F.col(measure) * 100.0, F.col("_total"))
    return out.withColumn(name, share if scale is None else half_up(share, scale)).drop("_total")


def explode_tokens(df: DataFrame, c: str, name: str = "word", min_length: int = 1) -> DataFrame:
    """One row per token of a text: whole lower-case runs of a-z and 0-9.

    The pattern passes over short runs, so no row is ever made of them.
    """
    run = F.lit(f"[a-z0-9]{{{min_length},}}")
    tokens = F.regexp_extract_all(F.lower(F.col(c)), run, F.lit(0))
    return df.withColumn(name, F.explode(tokens))


# ---- aggregation ----------------------------------------------------------

def having(df: DataFrame, cond: Column) -> DataFrame:
    return df.where(cond)


def count_distinct(c, approx: bool = False) -> Column:
    return F.approx_count_distinct(col(c)) if approx else F.count_distinct(col(c))


def approx_quantile(c, q, accuracy: int = 10000) -> Column:
    """Quantile from a bounded sketch; returns an element of the column."""
    return F.percentile_approx(col(c), q, accuracy)


def pivot_labels(df: DataFrame, key: str, label: str, values: dict[str, str], measure: str) -> DataFrame:
    """Turn the labels of a (key, label) aggregate into columns (label -> column name).
    The labels are named up front, so no extra pass looks for them."""
    return df.groupBy(key).agg(*[
        F.max(F.when(F.col(label) == lab, F.col(measure))).alias(out) for lab, out in values.items()
    ])


def unpivot(df: DataFrame, ids, values, var: str = "metric", value: str = "value") -> DataFrame:
    return df.unpivot([F.col(c) for c in ids], [F.col(c) for c in values], var, value)


def corr_pair(df: DataFrame, a: str, b: str) -> Column:
    return half_up(F.corr(a, b), 10**6)


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Correlation of every pair of columns, long form, from one pass.

    Rows with a null are left out pair by pair.
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        value = half_up(F.col(f"c{i}"), 10**6).alias("corr")
        cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), value))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), value))
    return one.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")


def crosstab_pct(df: DataFrame, row: str, label: str) -> DataFrame:
    """Share of each label among a row value's rows, in percent (long form)."""
    per = df.groupBy(row, label).agg(F.count(F.lit(1)).alias("n"))
    totals = per.groupBy(row).agg(F.sum("n").alias("_t"))
    return per.join(totals, row).select(
        row, label, "n", half_up(F.col("n") * 100.0 / F.col("_t"), 10).alias("pct")
    )


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    return df.select(c).distinct().orderBy(c)


def value_counts(df: DataFrame, c: str, name: str = "count") -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), c)


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, nulls, mean, deviation and range per column, long form, one pass."""
    stats = {
        "non_null": lambda c: F.count(c).cast("double"),
        "nulls": lambda c: F.count_if(F.col(c).isNull()).cast("double"),
        "mean": lambda c: half_up(F.avg(c), 10**4),
        "std": lambda c: half_up(F.stddev_samp(c), 10**4),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    one = df.agg(*[f(c).alias(f"{c}__{s}") for c in cols for s, f in stats.items()])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{s}").alias(s) for s in stats])
        for c in cols
    ])
    return one.select(F.explode(rows).alias("_r")).select("_r.*")


def histogram(df: DataFrame, c: str, bins: int) -> DataFrame:
    """Equal-width counts between the column's minimum and maximum (last bin closed)."""
    out = with_scalars(df.select(c).where(F.col(c).isNotNull()), _lo=F.min(c), _hi=F.max(c))
    width = (F.col("_hi") - F.col("_lo")).cast("double") / bins
    at = F.coalesce(F.floor(F.try_divide((F.col(c) - F.col("_lo")).cast("double"), width)), F.lit(0))
    return (
        out.select(F.least(at, F.lit(bins - 1)).cast("int").alias("bin"), "_lo", width.alias("_w"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.col("_lo") + F.col("_w") * F.col("bin")).alias("low"))
    )


def group_profile(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Mean and median of each integer column per group."""
    from mercata.operators.ranks import with_quantiles

    means = df.groupBy(key).agg(
        *[half_up(F.sum(c) / F.count(c), 100).alias(f"{c}_mean") for c in cols]
    )
    return with_quantiles(means, df, [key], {f"{c}_median": (c, 0.5, 100, 1) for c in cols})


# ---- order, limit, sample -------------------------------------------------

def sort(df: DataFrame, *cols: str, desc: bool = False) -> DataFrame:
    """Order with nulls last in either direction; a leading '-' flips a column."""
    keys = []
    for c in cols:
        down = c.startswith("-") != desc
        name = F.col(c.lstrip("-"))
        keys.append(name.desc_nulls_last() if down else name.asc_nulls_last())
    return df.orderBy(*keys)


def label_rank(c: str, labels: list[str]) -> Column:
    chain = F.when(F.col(c) == labels[0], 1)
    for i, label in enumerate(labels[1:], 2):
        chain = chain.when(F.col(c) == label, i)
    return chain.otherwise(len(labels) + 1)


def sort_by_label(df: DataFrame, c: str, labels: list[str]) -> DataFrame:
    return df.orderBy(label_rank(c, labels))


def top_k(df: DataFrame, c: str, k: int, asc: bool = False, tiebreak: list[str] | None = None) -> DataFrame:
    """The k rows with the largest (or smallest) value, nulls left out."""
    order = F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last()
    return df.where(F.col(c).isNotNull()).orderBy(order, *(tiebreak or [])).limit(k)


def extremes(df: DataFrame, c: str, k: int, tiebreak: list[str] | None = None) -> DataFrame:
    """The k smallest and the k largest rows together; a short table gives its rows twice."""
    return concat(top_k(df, c, k, True, tiebreak), top_k(df, c, k, False, tiebreak))


def rows_of_top_groups(df: DataFrame, group: str, measure: Column, k: int) -> DataFrame:
    """All rows of the k groups with the largest total; at most k keys are joined."""
    totals = df.groupBy(group).agg(measure.alias("_total"))
    best = top_k(totals, "_total", k, tiebreak=[group]).select(group)
    return df.join(F.broadcast(best), group, "left_semi")


def _draw(key, seed: int) -> Column:
    """A reproducible uniform number in [0, 1) per key, from a digest that other engines have too."""
    digest = F.md5(F.concat(col(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def sample_rows(df: DataFrame, pct: float, key: str, seed: int = 42) -> DataFrame:
    """Bernoulli sample; the same keys are drawn again after a retry or on another cluster."""
    return df if pct >= 100 else df.where(_draw(key, seed) * 100 < pct)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows drawn by hash order.  Rows are thinned to a little over n first, so
    only about n rows reach the final sort."""
    drawn = df.withColumn("_draw", _draw(key, seed))
    total = df.agg(F.count(F.lit(1)).alias("_rows"))
    enough = (F.lit(float(n)) + 8 * (n**0.5) + 16) / F.col("_rows")
    thinned = add_single_row(drawn, total).where(F.col("_draw") < enough)
    return thinned.orderBy("_draw", key).limit(n).drop("_draw", "_rows")


# ---- set operations and trimming ------------------------------------------

def concat(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def trim_upper(df: DataFrame, cols: list[str], q: float) -> DataFrame:
    """Keep rows at or below the q-quantile of each column (exact, one-row bound)."""
    from mercata.operators.ranks import quantiles

    bounds = quantiles(df, [], {f"_q_{c}": (c, q, None, 1) for c in cols})
    out = add_single_row(df, bounds)
    for c in cols:
        out = out.where(F.col(c) <= F.col(f"_q_{c}"))
    return out.drop(*bounds.columns)
