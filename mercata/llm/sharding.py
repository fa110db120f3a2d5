"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

The permutation works on pairs (left, right) below ``a * b``, the tightest grid that
holds all rows, and walks its cycle until it is back among the rows.  Place ``p`` of the
shuffle is slot ``p div shards`` of shard ``p mod shards``, so shard sizes differ by one
at most and the place of any row number can be computed without the table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercata.llm.support import blocks_of, hashed_block, stored

HALF_ROUNDS = 8
NUMBERED_ROWS = 50_000   # rows numbered by one task
BLOCKS_SUMMED = 1_024    # blocks whose counts are added up by one task
COPIES_AT_ONCE = 4_096


def grid(rows: int) -> tuple[int, int]:
    a = max(1, math.isqrt(rows))
    a += a * a < rows
    return a, max(1, -(-rows // a))


def permuted(index: Column, rows: int, seed: int) -> Column:
    """One pass of the permutation of 0 .. a*b-1; half rounds change left and right in turn."""
    a, b = grid(rows)
    steps = F.array(*[
        F.struct(F.lit(seed * HALF_ROUNDS + i).alias("key"), F.lit(b if i % 2 else a).alias("m"))
        for i in range(HALF_ROUNDS)
    ])
    start = F.struct((index % F.lit(a)).cast("long").alias("x"), F.floor(index / F.lit(a)).cast("long").alias("y"))
    if rows >= 1 << 52:
        raise ValueError("row numbers must stay exact as doubles")
    end = F.aggregate(
        steps, start,
        lambda s, step: F.struct(
            s["y"].alias("x"), ((s["x"] + F.pmod(F.xxhash64(s["y"], step["key"]), step["m"])) % step["m"]).alias("y")
        ),
    )
    return end["x"] + end["y"] * F.lit(a)


def walked(index: Column, rows: int, seed: int, steps: int) -> Column:
    """``steps`` more passes for whatever lies outside the rows."""
    if not steps:
        return index
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), index,
        lambda at, _: F.when(at >= rows, permuted(at, rows, seed)).otherwise(at),
    )


def walk_length(spark: SparkSession, rows: int, seed: int) -> int:
    """Passes that bring every row's cycle back among the rows, found by following the
    fewer than ``sqrt(rows) + 1`` numbers outside them."""
    a, b = grid(rows)
    outside, steps = a * b - rows, 0
    while steps < outside:
        steps = min(max(1, steps * 2), outside)
        at = walked(F.col("id"), rows, seed, steps)
        if spark.range(rows, a * b, numPartitions=blocks_of(outside, NUMBERED_ROWS)).filter(at >= rows).isEmpty():
            break
    return steps


def numbered(groups: DataFrame, order: list[str], copies: str) -> DataFrame:
    """Add ``first_row``, the number of rows before each group, to a table of
    (block, *order, copies) without a window over more than one block."""
    totals = groups.groupBy("block").agg(F.sum(copies).alias("n")).withColumn("part", F.floor(F.col("block") / BLOCKS_SUMMED))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = totals.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", before(Window.orderBy("part")).alias("part_before"))
    starts = (
        totals.withColumn("block_before", before(Window.partitionBy("part").orderBy("block")))
        .join(parts, "part")
        .select("block", (F.col("part_before") + F.col("block_before")).alias("block_start"))
    )
    inside = Window.partitionBy("block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        groups.withColumn("inside", F.coalesce(F.sum(copies).over(inside), F.lit(0)))
        .join(starts, "block")
        .withColumn("first_row", F.col("block_start") + F.col("inside"))
        .drop("block", "inside", "block_start")
    )


def assign_shards(docs: DataFrame, shards: int, seed: int = 7) -> DataFrame:
    """Shard and slot of every row of ``docs`` (doc_id, text), under the law of equal counts.

    Returns doc_id, size (UTF-8 bytes + 8), text_crc32, law, shard, slot, grown_shard (null:
    another shard count deals anew).  A null text counts as empty; rows that agree in doc_id,
    size and checksum are counted before any shuffle and dealt as neighbours, each to a place of its own;
    null ids are rows like others; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.count()
    key = ["doc_id", "size", "text_crc32"]
    groups = (
        docs.select(
            F.col("doc_id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        )
        .groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("block", hashed_block(blocks_of(rows, NUMBERED_ROWS), *key))
    )
    groups = numbered(stored(groups, "shards"), key, "copies")
    end = F.col("copies") - 1
    each = (
        groups.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), end, F.lit(COPIES_AT_ONCE).cast("long"))))
        .withColumn("nth", F.explode(F.sequence("chunk", F.least(F.col("chunk") + (COPIES_AT_ONCE - 1), end))))
        .withColumn("row", F.col("first_row") + F.col("nth"))
    )
    if rows:
        place = walked(permuted(F.col("row"), rows, seed), rows, seed, walk_length(spark, rows, seed))
    else:
        place = F.col("row")
    return each.withColumn("place", place).select(
        *key, F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
