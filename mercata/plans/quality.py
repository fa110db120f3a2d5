"""Checks on tables.  Each returns a DataFrame of findings, so checks can be
combined and written like any other table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FINDING = "check string, passed boolean, detail string"


def _finding(df: DataFrame, rows: list[tuple]) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, FINDING)


def _one(df: DataFrame, name: str, passed, detail, *aggs) -> DataFrame:
    return df.agg(*aggs).select(
        F.lit(name).alias("check"), passed.alias("passed"), detail.cast("string").alias("detail")
    )


def require_tables(tables: dict[str, DataFrame], names: list[str]) -> DataFrame:
    """Which of the named tables exist and have rows, with their number."""
    some = next(iter(tables.values()))
    found = [
        _one(tables[n], f"table {n}", F.col("n") > 0, F.col("n"), F.count(F.lit(1)).alias("n")) for n in names if n in tables
    ]
    missing = _finding(some, [(f"table {n}", False, "missing") for n in names if n not in tables])
    return reduce(DataFrame.unionByName, [*found, missing])


def check_rows(df: DataFrame, exact: int | None = None, name: str = "rows") -> DataFrame:
    """The exact row count, or that there is any row at all."""
    if exact is None:
        df = df.limit(1)
    passed = F.col("n") > 0 if exact is None else F.col("n") == exact
    return _one(df, name, passed, F.col("n"), F.count(F.lit(1)).alias("n"))


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Nulls per column, counted in one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], cols, "column", "nulls").select(
        F.concat(F.lit("no nulls in "), "column").alias("check"),
        (F.col("nulls") == 0).alias("passed"), F.col("nulls").cast("string").alias("detail"),
    )


def has_column(df: DataFrame, c: str) -> bool:
    return c in df.columns


def check_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Which columns a table has and fills, with the number of values."""
    there = [c for c in cols if has_column(df, c)]
    missing = _finding(df, [(f"column {c}", False, "missing") for c in cols if c not in there])
    if not there:
        return missing
    one = df.agg(*[F.count(c).alias(c) for c in there])
    return one.unpivot([], there, "column", "values").select(
        F.concat(F.lit("column "), "column").alias("check"), (F.col("values") > 0).alias("passed"),
        F.col("values").cast("string").alias("detail"),
    ).unionByName(missing)


def check_range(df: DataFrame, c: str, lo=None, hi=None) -> DataFrame:
    """All values lie within the closed bounds given."""
    inside = F.lit(True)
    if lo is not None:
        inside = inside & (F.col("lo") >= lo)
    if hi is not None:
        inside = inside & (F.col("hi") <= hi)
    span = F.concat_ws("..", F.col("lo").cast("string"), F.col("hi").cast("string"))
    return _one(df, f"{c} in range", inside, span, F.min(c).alias("lo"), F.max(c).alias("hi"))


def check_cardinality(df: DataFrame, c: str, n: int, at_least: bool = False) -> DataFrame:
    """The number of distinct values, exactly or at least."""
    passed = F.col("n") >= n if at_least else F.col("n") == n
    return _one(df, f"distinct {c}", passed, F.col("n"), F.count_distinct(c).alias("n"))


def check_rate(df: DataFrame, flag: str, lo: float, hi: float) -> DataFrame:
    """The share of flagged rows lies strictly between two percentages."""
    rate = F.avg(F.col(flag).cast("int")) * 100
    return _one(
        df, f"rate of {flag}", (F.col("r") > lo) & (F.col("r") < hi), F.round("r", 4), rate.alias("r")
    )


def flag_totals(df: DataFrame) -> DataFrame:
    """Rows, and how many carry each ``flag_`` column."""
    flags = [c for c in df.columns if c.startswith("flag_")]
    return df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c)).alias(c) for c in flags])


def rows_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
