"""Ranks, quantiles and running totals that never gather a group in one task.

A window over a category would put every row of a hot category in a single
task.  Two ideas avoid that; ranked columns are integers (cents, tenths, counts).

* ``counts_before`` reduces a group to its distinct values with counts (combined
  before the shuffle) and sums them in two levels: inside blocks of
  ``2**BLOCK_BITS`` neighbouring values, then over the blocks.
* ``placed`` gives every row a place of its own.  It cuts each group into cells of
  neighbouring values, orders inside a cell and adds what lies before it.  Cells with more
  than ``hot_rows`` rows are found from a histogram and cut finer, down to a share of the
  rows of one value, so no cell is unbounded.  The rows' one shuffle, by cell, serves the
  window and the join with the cells' starts.

``PERCENT_RANK`` depends on the value alone, so it needs no row's place: it is looked up in
``counts_before``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercata.functions.exact import col, half_up
from mercata.operators.relational import add_single_row

BLOCK_BITS = 20
CELL_BITS = 16
HOT_ROWS = 2_000_000  # a cell with more rows is cut finer, unless the caller says otherwise
NULL_RANK = 1 << 62  # nulls sort after every value
TIE_HEX_DIGITS = 4   # ties are spread over 16**4 buckets of the key's digest
NOT_CUT = -(1 << 63) + 1  # stands for the value where a cell is not cut


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """Join on equal keys where null matches null; right-hand keys are dropped."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    cond = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys], F.lit(True)
    )
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def prefix_sums(table: DataFrame, group: list[str], name: str, levels: int = 2) -> DataFrame:
    """Add to a table of (group, name, n, v) the sums of n and v before each row's name,
    and the group's totals.  Names are summed in blocks of ``2**BLOCK_BITS``, blocks in
    blocks again, so no window holds more than ``2**BLOCK_BITS`` rows but the last, which
    holds at most ``2**(62 - levels * BLOCK_BITS)``."""
    totals = {}
    if levels:
        block = f"_block{levels}"
        table = table.withColumn(block, F.shiftright(name, BLOCK_BITS))
        group_keys = [*group, block]
        blocks = table.groupBy(*group_keys).agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
        blocks = prefix_sums(blocks, group, block, levels - 1).drop("n", "v").withColumnsRenamed(
            {"n_before": "_n0", "v_before": "_v0"}
        )
    else:
        group_keys = group
        over = W.partitionBy(*group)
        totals = {"n_total": F.sum("n").over(over), "v_total": F.sum("v").over(over)}
    before = W.partitionBy(*group_keys).orderBy(name).rowsBetween(W.unboundedPreceding, -1)
    out = table.withColumns({
        "n_before": F.coalesce(F.sum("n").over(before), F.lit(0)),
        "v_before": F.coalesce(F.sum("v").over(before), F.lit(0)),
        **totals,
    })
    if not levels:
        return out
    return (
        null_safe_join(out, blocks, group_keys, "inner")
        .withColumns({
            "n_before": F.col("n_before") + F.col("_n0"), "v_before": F.col("v_before") + F.col("_v0"),
        })
        .drop(block, "_n0", "_v0")
    )


def _ranked(value) -> Column:
    """The value to rank by; nulls rank last."""
    return F.coalesce(col(value), F.lit(NULL_RANK)).cast("long")


def _counted(value) -> Column:
    """The value to sum; nulls add nothing."""
    return F.when(value == NULL_RANK, F.lit(0)).otherwise(value)


def counts_before(df: DataFrame, part: list[str], value, name: str = "value") -> DataFrame:
    """Per (part, value): rows with it ``n``, rows ordered before it ``n_before``,
    their sum ``v_before``, and the group's ``n_total`` and ``v_total``.

    Null values count as the last ones.
    """
    group = part or ["_all"]
    source = df if part else df.withColumn("_all", F.lit(0))
    per_value = (
        source.select(*group, _ranked(value).alias(name))
        .groupBy(*group, name)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("v", _counted(F.col(name)) * F.col("n"))
    )
    return prefix_sums(per_value, group, name).select(
        *part, name, "n", "n_before", "v_before", "n_total", "v_total"
    )


def quantiles(df: DataFrame, part: list[str], specs: dict[str, tuple]) -> DataFrame:
    """Exact interpolated quantiles of several columns in one pass.

    ``specs`` maps an output name to ``(column, q, scale, per_unit)``: the
    quantile rounded to ``1/scale`` of the stored integer unit, divided by ``per_unit``.
    A ``scale`` of None leaves it unrounded.  Nulls are ignored.
    """
    columns = list(dict.fromkeys(c for c, *_ in specs.values()))
    long = (
        df.select(
            *part,
            F.explode(F.array(*[
                F.struct(F.lit(i).alias("metric"), col(c).cast("long").alias("value"))
                for i, c in enumerate(columns)
            ])).alias("_m"),
        )
        .select(*part, "_m.metric", "_m.value")
    )
    # Groups where a column is null throughout still need an output row.
    ranked = counts_before(
        long.where(F.col("value").isNotNull()), [*part, "metric"], "value", "value"
    )
    last = F.col("n_total") - 1
    aggs = []
    for name, (c, q, _, _) in specs.items():
        at = last * F.lit(float(q))
        mine = F.col("metric") == columns.index(c)

        def pick(position: Column) -> Column:
            held = (F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n"))
            return F.max(F.when(mine & held, F.col("value")))

        aggs += [
            pick(F.floor(at)).alias(f"{name}__lo"),
            pick(F.ceil(at)).alias(f"{name}__hi"),
            F.max(F.when(mine, at - F.floor(at))).alias(f"{name}__w"),
        ]
    wide = ranked.groupBy(*part).agg(*aggs) if part else ranked.agg(*aggs)

    def finish(name, scale, per_unit):
        lo, hi, w = (F.col(f"{name}__{s}") for s in ("lo", "hi", "w"))
        value = lo + (hi - lo) * w
        if scale is not None:
            value = half_up(value, scale)
        return (value / F.lit(float(per_unit))).alias(name)

    return wide.select(*part, *[finish(n, s, u) for n, (_, _, s, u) in specs.items()])


def medians(df: DataFrame, cols: dict[str, str], cells_per_unit: int = 1000) -> DataFrame:
    """One row of exact medians of columns of doubles (output name -> column).

    Values are counted in cells first; only the distinct values of the cells that hold a middle
    row are then put in order."""
    names = list(cols)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("metric"), F.col(cols[n]).cast("double").alias("value")) for i, n in enumerate(names)
    ])).alias("_m")).select("_m.*").where(F.col("value").isNotNull())
    per = long.groupBy("metric", "value").agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"v": F.lit(0).cast("long"), "cell": F.floor(F.col("value") * cells_per_unit)}
    )
    cells = per.groupBy("metric", "cell").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    cells = prefix_sums(cells, ["metric"], "cell")
    low, high = F.floor((F.col("n_total") - 1) / 2), F.ceil((F.col("n_total") - 1) / 2)
    middle = cells.where((F.col("n_before") <= high) & (low < F.col("n_before") + F.col("n"))).select(
        "metric", "cell", "n_before", low.alias("_lo"), high.alias("_hi")
    )
    inside = W.partitionBy("metric", "cell").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    held = per.join(middle, ["metric", "cell"]).withColumn(
        "_from", F.col("n_before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    )
    def at(i, place):
        hit = (F.col("metric") == i) & (F.col("_from") <= F.col(place)) & (F.col(place) < F.col("_from") + F.col("n"))
        return F.max(F.when(hit, F.col("value")))

    return held.agg(*[((at(i, "_lo") + at(i, "_hi")) / 2).alias(n) for i, n in enumerate(names)])


def with_quantiles(agg: DataFrame, df: DataFrame, part: list[str], specs: dict) -> DataFrame:
    """Add quantile columns to an aggregate over the same groups."""
    found = quantiles(df, part, specs)
    return null_safe_join(agg, found, part) if part else add_single_row(agg, found)


def _without_nulls(c: str) -> Column:
    """A key that is never null, so that a window and a plain join share one partitioning."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))


def placed(
    df: DataFrame, part: list[str], value: str, key: str, descending: bool = False, hot_rows: int | None = None
) -> DataFrame:
    """Add to each row its 0-based ``rank`` within ``part`` (rows with a smaller value; nulls
    last), its own ``position`` and ``v_upto``, the running sum of the value, and the group's
    ``n_total`` and ``v_total``.

    Rows with equal values follow the digest of their key, which spreads a hot
    value over many cells and gives every engine the same order.  All columns of ``df`` are
    shuffled once, so hand over the few that are needed.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    sign = -1 if descending else 1
    group = [f"_k{i}" for i in range(len(part))] or ["_k0"]
    group_values = [_without_nulls(p) for p in part] or [F.lit("")]
    digest = F.md5(F.col(key))
    bucket = F.conv(F.substring(digest, 1, TIE_HEX_DIGITS), 16, 10).cast("int")

    def with_cell(frame):
        valued = frame.withColumns(dict(zip(group, group_values))).withColumn("_value", _ranked(F.col(value) * sign))
        return valued.withColumn("_cell", F.shiftright("_value", CELL_BITS))

    # 1. A histogram of cells, and the cells too full for one task.  There are at most rows / hot_rows of
    #    them (500,000 entries of some 30 bytes for 10**12 rows), so the list is broadcast and spares the
    #    rows a shuffle of their own.
    slim = with_cell(df.select(*dict.fromkeys([*part, value, key])))
    cells = slim.groupBy(*group, "_cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum(_counted(F.col("_value"))).alias("v")
    )
    cells = prefix_sums(cells, group, "_cell")
    hot = cells.where(F.col("n") > hot_rows).select(*group, "_cell", F.lit(True).alias("_hot"))

    def marked(frame):
        return frame.join(F.broadcast(hot), [*group, "_cell"], "left").withColumns({
            "_sub": F.when(F.col("_hot"), F.col("_value")).otherwise(F.lit(NOT_CUT)),
            "_bucket": F.when(F.col("_hot"), bucket).otherwise(F.lit(-1)),
        })

    rows = marked(with_cell(df))

    # 2. Hot cells split by value and key digest.
    per_value = ["_cell", "_sub"]
    fine = marked(slim).where("_hot").groupBy(*group, *per_value, "_bucket").agg(F.count(F.lit(1)).alias("_m"))
    ties = W.partitionBy(*group, *per_value).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    fine = fine.withColumn("_ties", F.coalesce(F.sum("_m").over(ties), F.lit(0)))
    values = fine.groupBy(*group, *per_value).agg(F.sum("_m").alias("_m"))
    lower = W.partitionBy(*group, "_cell").orderBy("_sub").rowsBetween(W.unboundedPreceding, -1)
    values = values.select(
        *group, *per_value,
        F.coalesce(F.sum("_m").over(lower), F.lit(0)).alias("_below"),
        F.coalesce(F.sum(_counted(F.col("_sub")) * F.col("_m")).over(lower), F.lit(0)).alias("_vbelow"),
    )
    fine = fine.drop("_m").join(values, [*group, *per_value])
    zero = F.lit(0).cast("long")
    starts = cells.where(F.col("n") <= hot_rows).withColumns({
        "_sub": F.lit(NOT_CUT), "_bucket": F.lit(-1), "_ties": zero, "_below": zero, "_vbelow": zero,
    }).unionByName(fine.join(cells, [*group, "_cell"])).drop("n", "v")

    # 3. Order inside the cell and add what lies before; one shuffle serves window and join.
    keys = [*group, "_cell", "_sub", "_bucket"]
    inside = W.partitionBy(*keys).orderBy("_value")
    exact = W.partitionBy(*keys).orderBy("_value", "_digest", key)
    ranked = rows.withColumn("_digest", digest).withColumns({
        "_rank": F.rank().over(inside), "_nth": F.row_number().over(exact),
        "_run": F.sum(_counted(F.col("_value"))).over(exact.rowsBetween(W.unboundedPreceding, 0)),
    })
    out = ranked.join(starts, keys)
    start = F.col("n_before") + F.col("_below")
    done = _counted(F.col("_value")) * F.col("_ties")
    return out.select(
        *[ranked[c] for c in df.columns], (start + F.col("_rank") - 1).alias("rank"),
        (start + F.col("_ties") + F.col("_nth") - 1).alias("position"),
        ((F.col("v_before") + F.col("_vbelow") + done + F.col("_run")) * sign).alias("v_upto"),
        "n_total", (F.col("v_total") * sign).alias("v_total"),
    )


def percent_rank_in(df: DataFrame, part: list[str], cols: dict[str, str]) -> DataFrame:
    """Add ``PERCENT_RANK`` of each column within ``part`` (output name -> column).

    The rank is looked up by value in a table that is counted before it is shuffled."""
    out = df
    for name, c in cols.items():
        share = F.when(F.col("n_total") == 1, F.lit(0.0)).otherwise(F.col("n_before") / (F.col("n_total") - 1))
        found = counts_before(df.select(*part, c), part, c, "_looked_up").select(*part, "_looked_up", share.alias(name))
        out = null_safe_join(out.withColumn("_looked_up", _ranked(c)), found, [*part, "_looked_up"]).drop("_looked_up")
    return out


def ordered_position(
    df: DataFrame, part: list[str], value: str, key: str, descending: bool = False, hot_rows: int | None = None
) -> DataFrame:
    """Rows with their unique ``position`` by value, then key digest (see :func:`placed`)."""
    return placed(df, part, value, key, descending, hot_rows).drop("rank")


def ntile_in(
    df: DataFrame, part: list[str], order: str, n: int, key: str, name: str = "ntile", hot_rows: int | None = None
) -> DataFrame:
    """Add ``NTILE(n)`` of the rows ordered by ``order`` then key digest."""
    rows = ordered_position(df, part, order, key, hot_rows=hot_rows)
    size = F.floor(F.col("n_total") / n)
    extra = F.col("n_total") % n
    fat = extra * (size + 1)
    p = F.col("position")
    tile = F.when(p < fat, F.floor(p / (size + 1))).otherwise(
        extra + F.floor(F.try_divide((p - fat).cast("double"), size))
    )
    return rows.select(*df.columns, (tile + 1).cast("int").alias(name))


def concentration_curve(df: DataFrame, measure: str, key: str, per_unit: int = 100) -> DataFrame:
    """Rows by falling measure with their rank, running total, and both as shares."""
    rows = ordered_position(df.select(key, measure), [], measure, key, descending=True)
    return rows.select(
        key,
        (F.col(measure) / F.lit(float(per_unit))).alias("total"),
        (F.col("position") + 1).alias("rank"),
        (F.col("v_upto") / F.lit(float(per_unit))).alias("cumulative"),
        (F.try_divide(F.col("v_upto").cast("double"), F.col("v_total")) * 100).alias("cum_pct_total"),
        ((F.col("position") + 1).cast("double") / F.col("n_total") * 100).alias("cum_pct_rows"),
    )


def concentration_summary(df: DataFrame, measure: str, shares=(50, 80, 90), top_pct: int = 1) -> DataFrame:
    """How many top rows hold each share of the total, and what the top 1% hold.

    Works on distinct values with counts: within a run of equal values the
    running total grows by the value, so the cut is found by division.
    """
    v = counts_before(df.withColumn("_neg", -F.coalesce(F.col(measure), F.lit(0))), [], "_neg", "neg")
    value, total = -F.col("neg"), -F.col("v_total")
    before = -F.col("v_before")
    aggs = []
    for share in shares:
        # rows whose running total stays within share% of the total
        room = F.lit(share) * total - 100 * before
        fit = F.when(room < 0, F.lit(0)).when(value <= 0, F.col("n")).otherwise(
            F.least(F.col("n"), F.floor(F.try_divide(room.cast("double"), 100 * value)))
        )
        aggs.append(F.sum(fit).cast("long").alias(f"rows_for_{share}pct"))
    top_n = F.greatest(F.floor(F.col("n_total") * top_pct / 100), F.lit(1))
    taken = F.greatest(F.least(F.col("n"), top_n - F.col("n_before")), F.lit(0))
    aggs += [
        F.sum(taken * value).alias("_top"),
        F.max(total).alias("_total"),
        F.max("n_total").alias("rows_total"),
    ]
    out = v.agg(*aggs)
    return out.select(
        "rows_total",
        *[f"rows_for_{s}pct" for s in shares],
        half_up(F.try_divide(F.col("_top").cast("double"), F.col("_total")) * 100, 10).alias(
            f"top_{top_pct}pct_share"
        ),
    )


FEW_WANTED = 64  # rows whose places are counted directly, in one pass over their groups


def percentile_position(
    df: DataFrame, part: str, key: str, wanted: list, cols: dict[str, str]
) -> DataFrame:
    """``PERCENT_RANK`` of a few chosen rows: rows below them over rows less one.

    The chosen rows' groups are named by value, so that a table sorted by ``part`` is read in part only.  Up to
    ``FEW_WANTED`` rows are compared with their groups directly, all measures in one pass, which is
    combined before its shuffle; more of them look their ranks up by value, as in :func:`percent_rank_in`.
    """
    measures = list(dict.fromkeys(cols.values()))
    mine = df.where(F.col(key).isin(list(wanted))).select(key, part, *measures)
    if len(wanted) > FEW_WANTED:
        return _looked_up_positions(df, mine, part, key, cols)
    found = mine.limit(FEW_WANTED + 1).collect()
    if len(found) > FEW_WANTED:  # ids that many rows share
        return _looked_up_positions(df, mine, part, key, cols)
    groups = {r[part] for r in found}
    inside = F.col(part).isin([g for g in groups if g is not None])
    peers = df.where(inside | F.col(part).isNull() if None in groups else inside).select(part, *measures)
    names = ["_row", "_part", *[f"_own{i}" for i in range(len(measures))]]
    kinds = {f.name: f.dataType for f in mine.schema.fields}
    schema = T.StructType([T.StructField(n, kinds[c]) for n, c in zip(names[1:], [part, *measures])])
    rows = [(i, *(r[c] for c in (part, *measures))) for i, r in enumerate(found)]
    own = df.sparkSession.createDataFrame(rows, T.StructType([T.StructField("_row", T.IntegerType()), *schema.fields]))
    below = [
        F.count_if(_ranked(c) < _ranked(o)).alias(f"_below{i}")
        for i, (c, o) in enumerate(zip(measures, names[2:]))
    ]
    # At most FEW_WANTED rows are broadcast.
    met = peers.join(F.broadcast(own), F.col(part).eqNullSafe(F.col("_part")))
    counts = met.groupBy("_row").agg(F.count(F.lit(1)).alias("_n"), *below)
    keys = df.sparkSession.createDataFrame(
        [(i, r[key], r[part]) for i, r in enumerate(found)],
        T.StructType([T.StructField("_row", T.IntegerType()), T.StructField(key, kinds[key]), T.StructField(part, kinds[part])]),
    )
    share = {
        name: F.when(F.col("_n") == 1, F.lit(0.0)).otherwise(F.col(f"_below{measures.index(c)}") / (F.col("_n") - 1))
        for name, c in cols.items()
    }
    return counts.join(F.broadcast(keys), "_row").select(key, part, *[v.alias(n) for n, v in share.items()])


def _looked_up_positions(df: DataFrame, mine: DataFrame, part: str, key: str, cols: dict[str, str]) -> DataFrame:
    groups = mine.select(F.col(part).alias("_part")).distinct()
    peers = df.select(part, *dict.fromkeys(cols.values())).join(groups, F.col(part).eqNullSafe(F.col("_part")), "left_semi")
    out = mine
    for name, c in cols.items():
        share = F.when(F.col("n_total") == 1, F.lit(0.0)).otherwise(F.col("n_before") / (F.col("n_total") - 1))
        found = counts_before(peers, [part], c, "_looked_up").select(part, "_looked_up", share.alias(name))
        out = null_safe_join(out.withColumn("_looked_up", _ranked(c)), found, [part, "_looked_up"]).drop("_looked_up")
    return out.select(key, part, *cols)


def quantile_buckets(df: DataFrame, c: str, n: int = 5, name: str = "bucket") -> DataFrame:
    """Cut a column at its quantiles into right-closed buckets.

    Equal edges collapse, the first bucket includes the minimum.  Adds the
    bucket number and its bounds.  The edges are one row, broadcast.
    """
    specs = {f"_e{i}": (c, i / n, None, 1) for i in range(n + 1)}
    edges = quantiles(df, [], specs).select(
        F.array_sort(F.array_distinct(F.array(*specs))).alias("_edges")
    )
    joined = add_single_row(df, edges)
    upper = F.expr(f"filter(_edges, e -> e < {c})")
    at = F.greatest(F.size(upper), F.lit(1))
    return (
        joined.withColumn(name, F.when(F.col(c).isNotNull(), at).cast("int"))
        .withColumns({
            f"{name}_low": F.get("_edges", F.col(name) - 1),
            f"{name}_high": F.get("_edges", F.col(name)),
        })
        .drop("_edges")
    )


def majority(df: DataFrame, part: list[str], label: str) -> DataFrame:
    """The most frequent label per group with its share of the group's rows, in percent."""
    per_label = df.groupBy(*part, label).agg(F.count(F.lit(1)).alias("cnt"))
    top = F.max_by(F.struct(label, "cnt"), F.struct("cnt", label))
    best = per_label.groupBy(*part).agg(top.alias("_top"), F.sum("cnt").alias("_all"))
    return best.select(
        *part, F.col(f"_top.{label}").alias(label), F.col("_top.cnt").alias("cnt"),
        half_up(F.col("_top.cnt") * 100.0 / F.col("_all"), 10).alias("pct"),
    )


# The following work on aggregates (a few rows per group), so plain windows serve.

def share_of_group(df: DataFrame, part: list[str], measure: str, name: str = "share_pct") -> DataFrame:
    """Each aggregated row's measure as a percentage of its group's total."""
    total = F.sum(measure).over(W.partitionBy(*part))
    return df.withColumn(name, F.try_divide(F.col(measure).cast("double"), total) * 100)


def argmax_row(df: DataFrame, part: list[str], measure: str, tiebreak: str) -> DataFrame:
    """The row with the largest measure per group; ties go to the larger ``tiebreak``."""
    rest = [c for c in df.columns if c not in part]
    best = df.where(F.col(measure).isNotNull()).groupBy(*part).agg(
        F.max_by(F.struct(*rest), F.struct(measure, tiebreak)).alias("_best")
    )
    return best.select(*part, "_best.*")


def pct_change(df: DataFrame, part: list[str], order: str, measure: str, name: str = "change_pct") -> DataFrame:
    """Change from the previous period in percent; null without one or from zero."""
    prev = F.lag(measure).over(W.partitionBy(*part).orderBy(order))
    return df.withColumn(name, (F.try_divide(F.col(measure).cast("double"), prev) - 1) * 100)
