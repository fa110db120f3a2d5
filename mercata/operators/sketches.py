"""Sketches that are stored per group and merged into larger groups: quantiles and distinct counts.

A sketch has a bounded size whatever the group's, so a key with a third of all rows costs no more than another, and
totals over categories, months or loads come from the stored sketches, not from the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILE_K = 800        # items a level of a quantile sketch keeps; exact up to about so many rows
PLACES = 512            # evenly spaced ranks a sketch is asked for; groups of fewer rows get exact neighbours
RANK_ERROR = 0.01       # of a quantile from such a sketch, as share of the group's rows
DISTINCT_BITS = 12      # 4,096 registers
DISTINCT_ERROR = 0.05   # three standard errors of a distinct count from such a sketch


def quantile_sketches(df: DataFrame, keys: list[str], column: str, k: int = QUANTILE_K) -> DataFrame:
    """(keys, sketch): a KLL sketch of the column's values per group; nulls don't count."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(k)).alias("sketch"))


def merge_quantiles(sketches: DataFrame, keys: list[str], k: int = QUANTILE_K) -> DataFrame:
    """(keys, sketch) of larger groups, from the sketches of their parts."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_quantile(sketch: str | Column, q: float) -> Column:
    """The quantile, interpolated between the two items whose places enclose it, as an exact one would be; null for an
    empty group.  Within ``RANK_ERROR`` of the rank."""
    n = F.kll_sketch_get_n_double(sketch)
    # The function takes constant ranks only, so the sketch gives items at evenly spaced ones.
    items = F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit((i + 0.5) / PLACES) for i in range(PLACES)]))
    place = (n - 1) * F.lit(float(q))
    at = lambda i: F.get(items, F.least(F.floor((i + 0.5) / n * PLACES), F.lit(PLACES - 1)).cast("int"))
    low, high = at(F.floor(place)), at(F.ceil(place))
    return F.when(n > 0, low + (high - low) * (place - F.floor(place)))


def rank_checked(df: DataFrame, keys: list[str], column: str, q: float, estimates: DataFrame, bound: float = RANK_ERROR) -> DataFrame:
    """(keys, estimate, within): whether an estimate's place among the group's rows is within ``bound`` of ``q``."""
    # Rows up to the estimate, and rows below it: the estimate's place is between the two.
    joined = df.join(estimates, keys).where(F.col(column).isNotNull())
    places = joined.groupBy(*keys, "estimate").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(column) < F.col("estimate")).alias("below"),
        F.count_if(F.col(column) <= F.col("estimate")).alias("up_to"),
    )
    # Between two neighbouring items, interpolation may be off by one row at either side.
    slack = F.col("n") * bound + 1
    return places.select(
        *keys, "estimate", ((F.col("below") <= F.col("n") * q + slack) & (F.col("up_to") >= F.col("n") * q - slack)).alias("within")
    )


def distinct_checked(df: DataFrame, keys: list[str], column: str, sketches: DataFrame, bound: float = DISTINCT_ERROR) -> DataFrame:
    """(keys, exact, within): the exact distinct count of each group, and whether its sketch's estimate is within ``bound`` of it."""
    exact = df.groupBy(*keys).agg(F.count_distinct(column).alias("exact")).join(sketches, keys)
    gap = F.abs(sketch_distinct("sketch") - F.col("exact"))
    return exact.select(*keys, "exact", (gap <= F.col("exact") * bound + 1).alias("within"))


def distinct_sketches(df: DataFrame, keys: list[str], column: str, bits: int = DISTINCT_BITS) -> DataFrame:
    """(keys, sketch): a HyperLogLog sketch of the column's values per group; nulls don't count."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(column), F.lit(bits)).alias("sketch"))


def merge_distinct(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, sketch) of larger groups; a value that several parts hold counts once."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def sketch_distinct(sketch: str | Column) -> Column:
    """The estimate from the registers alone, which are the same however parts were merged: a sketch that has seen its
    rows one by one would otherwise use the order they came in."""
    return F.hll_sketch_estimate(F.hll_union(sketch, sketch))
