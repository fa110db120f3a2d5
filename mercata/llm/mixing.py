"""Mixing sources to target weights by Pareto order sampling.

A source's documents are wanted ``target / size`` times on average.  The whole part of
that number is allocated for certain; for the rest, a document is included with a chance that grows with its
size, so that the words included are the rest on average.  Documents are ranked by random odds
divided by their inclusion odds and taken in that order until the words reach the target.
The cut of a source is found by zooming into a histogram of the ranks, so no task
sorts a source, and applies to each row by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercata.llm.support import stored, uniform

WEIGHTS = (3, 1, 2)
SHARE = 1.5          # words of the mix per word of the input
MOST = 2             # a document is taken this often at most
SLICES = 1_024       # slices of the histogram
SORTED_ROWS = 20_000  # rows of a source that are ranked one by one
LEAST_ODDS = 1e-9
EQUAL_AT_ONCE = 4_096  # rows of a group of equal ones that are counted out at once
DRAWN_BY = ("doc_id", "size", "print", "nth")
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key without nulls that orders like the source, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def targets(sizes: DataFrame) -> DataFrame:
    """Words wanted of each source, from a table (key, source_size).

    Targets rise with the weights until they meet the cap; the level at which the sum is
    right follows from the sources in order of the size at which they are capped."""
    nth = F.row_number().over(Window.orderBy("key")) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (nth % len(WEIGHTS) + 1).cast("int"))
    caps = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * MOST)
    caps = caps.withColumn("full_at", F.col("cap") / F.col("weight"))
    rising = Window.orderBy("full_at", "key")
    wanted = F.sum("source_size").over(Window.partitionBy()) * F.lit(SHARE)
    taken = F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = caps.withColumn("level", (wanted - taken) / left)
    level = F.min_by(
        F.when(F.col("level") <= F.col("full_at"), F.col("level")),
        F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "key")),
    ).over(Window.partitionBy())
    return levels.withColumn("water", level).select(
        "key", "source_size",
        F.when(F.col("water") * F.col("weight") < F.col("cap"), F.col("water") * F.col("weight"))
        .otherwise(F.col("cap").cast("double")).alias("target"),
    )


def rank(inclusion: Column, seed: int, *columns) -> Column:
    """Logarithm of the Pareto rank: random odds over inclusion odds."""
    u = uniform(seed, *columns)
    return F.log(u) - F.log1p(-u) - F.log(inclusion) + F.log1p(-inclusion)


def inclusion(slope: Column, size: Column) -> Column:
    """Chance of one more copy of a document: ``slope`` times its size, short of 0 and 1."""
    return F.greatest(F.lit(LEAST_ODDS), F.least(F.lit(1 - LEAST_ODDS), slope * size))


def cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source, the last row that is taken once more: (key, cut) with cut a struct
    (rank, doc_id, size).  ``rows``: key, doc_id, size, rank; ``plan``: key, rest (words).

    Every round keeps, per source, the slice of ranks in which the words run out, and cuts it
    finer until it holds few rows or no narrower slice exists; only those rows are sorted."""
    span = rows.groupBy("key").agg(F.min("rank").alias("low"), F.max("rank").alias("high"))
    state = stored(
        plan.join(span, "key").select("key", "rest", "low", (F.col("high") + F.lit(1e-9)).alias("high")), "mix-span"
    )
    while True:
        inside = rows.join(state, "key").filter((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
        width = (F.col("high") - F.col("low")) / SLICES
        slices = inside.withColumn("slice", F.least(F.floor((F.col("rank") - F.col("low")) / width), F.lit(SLICES - 1)))
        slices = slices.groupBy("key", "slice", "rest", "low", "high").agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"),
            F.min("rank").alias("first"), F.max("rank").alias("last"),
        )
        before = F.coalesce(
            F.sum("words").over(Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        )
        found = (
            slices.withColumn("before", before).filter(F.col("before") <= F.col("rest"))
            .groupBy("key").agg(F.max_by(F.struct("before", "rest", "first", "last", "n"), "slice").alias("s"))
        )
        state = stored(
            found.select(
                "key", (F.col("s.rest") - F.col("s.before")).alias("rest"), F.col("s.first").alias("low"),
                F.col("s.last").alias("high"), F.col("s.n").alias("n"),
            ), "mix-slice",
        )
        wide = state.filter((F.col("n") > SORTED_ROWS) & (F.col("high") - F.col("low") > F.lit(1e-9)))
        if wide.isEmpty():
            break
        state = state.select("key", "rest", "low", (F.col("high") + F.lit(1e-12)).alias("high"))
    last = rows.join(state, "key").filter((F.col("rank") >= F.col("low")) & (F.col("rank") <= F.col("high")))
    order = Window.partitionBy("key").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
    kept = last.filter(F.col("before") + F.col("size") / 2 <= F.col("rest"))
    cut = kept.groupBy("key").agg(F.max(F.struct("rank", "doc_id", "size")).alias("cut"))
    return state.select("key", F.col("low").alias("floor")).join(cut, "key", "left")


def equal_rows(docs: DataFrame) -> DataFrame:
    """(key, doc_id, size, print, n): how many rows agree in source, doc_id and text."""
    rows = docs.select(
        source_key(F.col("source")).alias("key"), F.col("doc_id"), words(F.col("text")).alias("size"), F.xxhash64("text").alias("print")
    )
    return stored(rows.groupBy("key", "doc_id", "size", "print").agg(F.count(F.lit(1)).alias("n")), "mix-rows")


def counted(groups: DataFrame) -> DataFrame:
    """One row for each row of the groups, with its number ``nth`` among its equals."""
    end = F.col("n") - 1
    return (
        groups.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), end, F.lit(EQUAL_AT_ONCE).cast("long"))))
        .withColumn("nth", F.explode(F.sequence("chunk", F.least(F.col("chunk") + (EQUAL_AT_ONCE - 1), end))))
        .drop("n", "chunk")
    )


def numbered(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Add ``nth``, a row's number among its equals, to (row, key, size, print).

    Repeated rows, the only ones that need counting, are written and numbered in two levels: partition
    by partition, then inside each, so that a group of any size is spread over the tasks."""
    many = groups.filter("n > 1").select("key", F.col("doc_id").alias("id"), "size", "print", F.lit(True).alias("many"))
    if many.isEmpty():
        return rows.withColumn("nth", F.lit(0).cast("long"))
    r, m = rows.withColumn("id", F.col("row.doc_id")).alias("r"), many.alias("m")
    names = ["key", "id", "size", "print"]
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"m.{c}")) for c in names]
    flagged = r.join(m, same, "left").select("r.*", "m.many")
    once = flagged.filter("many is null").select("row", "key", "size", "print", F.lit(0).cast("long").alias("nth"))
    repeated = stored(flagged.filter("many").drop("many").withColumn("no", F.monotonically_increasing_id()), "mix-repeated")
    repeated = repeated.withColumn("part", F.shiftright("no", 33))  # its upper bits are the partition's number
    parts = repeated.groupBy(*names, "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy(*names).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows").alias("p")
    inside = F.row_number().over(Window.partitionBy(*names, "part").orderBy("no")) - 1
    placed = repeated.withColumn("inside", inside).alias("r")
    on = [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in [*names, "part"]]
    placed = placed.join(parts, on).select("r.row", "r.key", "r.size", "r.print", (F.col("p.start") + F.col("r.inside")).alias("nth"))
    return once.unionByName(placed)


def mix_plan(groups: DataFrame, seed: int = 11) -> DataFrame:
    """Per source: key, source_size, target, whole (certain copies), slope (inclusion of one more copy per word),
    floor and cut (ranks that are taken)."""
    each = F.col("size").cast("decimal(19,0)") * F.col("size") * F.col("n")
    sizes = stored(groups.groupBy("key").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum(each).cast("double").alias("squares")
    ), "mix-sizes")
    times = F.col("target") / F.nullif(F.col("source_size"), F.lit(0))
    whole = F.coalesce(F.floor(times), F.lit(0)).cast("int")
    plan = targets(sizes.select("key", "source_size")).withColumn("whole", whole).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")
    )
    slope = F.col("rest") / F.nullif(F.col("squares"), F.lit(0.0))
    plan = stored(plan.join(sizes.select("key", "squares"), "key").withColumn("slope", slope).drop("squares"), "mix-plan")
    drawn = plan.filter("rest > 0 and rest < source_size")
    ranked = counted(groups.join(drawn.select("key", "slope"), "key")).withColumn(
        "rank", rank(inclusion(F.col("slope"), F.col("size")), seed, *map(F.col, DRAWN_BY))
    )
    cut = cuts(ranked.drop("slope", "print", "nth"), drawn.select("key", "rest"))
    return stored(plan.join(cut, "key", "left"), "mix-cuts")


def mix(docs: DataFrame, seed: int = 11) -> DataFrame:
    """All rows of ``docs`` as (row, mix): the row's columns, and size, source_size, target, copies.

    A null or empty text has size 0 and a null source is a source of its own; texts of any length are counted
    whole.  Each row is drawn for itself, null and repeated ids and equal rows included: of equal rows, their number
    decides how many are taken once more.  An empty table gives no rows.  What is taken depends on doc_id, text, number
    of equal rows and seed only, so reruns and retries agree.  Other columns may have any names.
    """
    groups = equal_rows(docs)
    plan = mix_plan(groups, seed).select(F.struct("*").alias("plan"))
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.select(
        "row", source_key(F.col("row.source")).alias("key"), words(F.col("row.text")).alias("size"), F.xxhash64("row.text").alias("print")
    )
    joined = numbered(rows, groups).withColumn("doc_id", F.col("row.doc_id")).join(plan, F.col("key") == F.col("plan.key"))
    own = F.struct(
        rank(inclusion(F.col("plan.slope"), F.col("size")), seed, *map(F.col, DRAWN_BY)).alias("rank"), F.col("doc_id"), F.col("size"),
    )
    more = F.coalesce((own["rank"] < F.col("plan.floor")) | (own <= F.col("plan.cut")), F.lit(False))
    return joined.select("row", F.struct(
        F.col("size"), F.col("plan.source_size").alias("source_size"), F.col("plan.target").alias("target"),
        (F.col("plan.whole") + more.cast("int")).alias("copies"),
    ).alias("mix"))


def mixture(docs: DataFrame, seed: int = 11) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its columns."""
    taken = mix(docs, seed).filter("mix.copies > 0")
    return taken.select(F.explode(F.array_repeat("row", F.col("mix.copies"))).alias("row")).select("row.*")
