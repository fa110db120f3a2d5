"""Writing, appending, loading and checking tables."""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercata.functions.exact import half_up
from mercata.session import shuffles_dropped


def materialize(
    df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None, look_up: list[str] | None = None
) -> DataFrame:
    """Write a table, replacing what was there, and read it back.

    ``sort_by`` puts neighbouring values into the same files, so that a filter on them skips most row groups;
    ``look_up`` adds bloom filters on columns that single values are looked for in.
    """
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    for c in look_up or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_dropped(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, path: str, name: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a table dealt into ``buckets`` by its keys and sorted by them, and register it under ``name``.

    Aggregates and joins by the keys then need no shuffle.  All rows of a key lie in one bucket, which one task reads: for a
    table of which one key holds a large share, write :func:`materialize`'s plain one, whose aggregates combine before they shuffle.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    (
        df.repartition(buckets, *keys).write.mode("overwrite").option("compression", "zstd").option("path", path)
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    )
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str, name: str, schema: T.StructType, keys: list[str], buckets: int) -> DataFrame:
    """Register what :func:`materialize_bucketed` wrote, in a session that doesn't know it."""
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    spark.sql(
        f"CREATE TABLE `{name}` ({schema.toDDL()}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def define_view(df: DataFrame, name: str) -> DataFrame:
    """Name a lazy table for SQL; nothing is copied."""
    df.createOrReplaceTempView(name)
    return df


# Files a task keeps open at once, and the bytes it holds of each: 512 MB at most.  Rows of further partitions are sorted by partition.
OPEN_FILES, HELD_BYTES = 32, 16 << 20


def append_reviews(df: DataFrame, path: str, load: str) -> None:
    """Add late reviews to the table under the name of their load.

    The table is partitioned by source category and load, and a load replaces
    only itself: another load adds to a category, a rerun changes nothing.
    A task writes to the files of up to ``OPEN_FILES`` categories as rows come, so that whole texts are not sorted, and spilled, first.
    """
    spark, setting = df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, OPEN_FILES)
    try:
        (
            df.withColumn("load", F.lit(load))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd").option("parquet.block.size", HELD_BYTES)
            .partitionBy("source_category", "load")
            .parquet(path)
        )
    finally:
        spark.conf.set(setting, before)


def _table_folders(spark: SparkSession, folder: str) -> dict[str, str]:
    """Parquet tables below a folder, by name without its suffix (any Hadoop file system)."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not name.startswith((".", "_")):
            found[name.removesuffix(".parquet")] = status.getPath().toString()
    return found


def load_tables(spark: SparkSession, folder: str, register: bool = True) -> dict[str, DataFrame]:
    """Every Parquet table in a folder, under its file stem."""
    tables = {n: spark.read.parquet(p) for n, p in sorted(_table_folders(spark, folder).items())}
    if register:
        for name, df in tables.items():
            define_view(df, name)
    return tables


def export_gold(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write serving tables as zstd Parquet; returns where each went."""
    paths = {}
    for name, df in tables.items():
        paths[name] = os.path.join(folder, f"{name}.parquet")
        materialize(df, paths[name])
    return paths


def profile_files(df: DataFrame) -> DataFrame:
    """Files behind a table: name, size and rows of each."""
    return df.groupBy(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("bytes"),
    ).agg(F.count(F.lit(1)).alias("rows"))


RAW_KINDS = {"csv": "csv", "json": "json lines", "jsonl": "json lines", "parquet": "parquet"}


def raw_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every file below a folder before anything is parsed: path, name, kind (by its suffix, without that of a
    compression) and size.  Only the listing is read, not the files; Spark leaves empty ones out."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.col("_metadata.file_name")
    suffix = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)(?:\.(?:gz|bz2|zst|lz4|snappy))?$", 1))
    kinds = F.create_map(*[F.lit(x) for pair in RAW_KINDS.items() for x in pair])
    return found.select(
        "path", name.alias("file_name"), F.coalesce(F.try_element_at(kinds, suffix), F.lit("other")).alias("kind"),
        F.col("length").alias("bytes"),
    )


def raw_profile(spark: SparkSession, folder: str) -> DataFrame:
    """(kind, files, bytes, megabytes, largest) of a folder of raw files, one row for each kind."""
    return raw_files(spark, folder).groupBy("kind").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), half_up(F.sum("bytes") / (1 << 20), 10).alias("megabytes"),
        F.max("bytes").alias("largest"),
    )


def readable_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name, kind, bytes, lines, bad_lines, readable): text files line by line, whether each can be read as what its
    suffix says.  A JSON line is bad if it does not parse; a CSV file if its quotes don't pair; a compressed or other file is only listed."""
    files = raw_files(spark, folder)
    text = files.where(F.col("kind").isin("csv", "json lines") & ~F.lower("file_name").rlike(r"\.(gz|bz2|zst|lz4|snappy)$"))
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(folder).select(
        F.col("_metadata.file_name").alias("file_name"), "value"
    ).where(F.lower("file_name").rlike(r"\.(csv|json|jsonl)$"))
    broken = F.lower("file_name").rlike(r"\.jsonl?$") & (F.trim("value") != "") & F.try_parse_json("value").isNull()
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    seen = lines.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(broken).alias("bad_lines"), (F.sum(quotes) % 2 == 1).alias("open_quote")
    )
    whole = text.join(seen, "file_name", "left")
    odd = F.coalesce((F.col("kind") == "csv") & F.col("open_quote"), F.lit(False))
    return whole.select(
        "file_name", "kind", "bytes", F.coalesce("lines", F.lit(0).cast("long")).alias("lines"),
        F.coalesce("bad_lines", F.lit(0).cast("long")).alias("bad_lines"),
        ((F.coalesce("bad_lines", F.lit(0)) == 0) & ~odd).alias("readable"),
    )


def profile_schema(df: DataFrame) -> DataFrame:
    """Column names and types of a table, in order, with the values each column holds."""
    names = df.columns
    one = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)])
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"), F.col(f"c{i}").alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ])
    return one.select(F.explode(rows).alias("_r")).select("_r.*")


def bench_read(df: DataFrame) -> DataFrame:
    """Read a table in full, keeping nothing, and report rows, seconds and rows per second."""
    start = time.time()
    seen = Observation("read")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    seconds = time.time() - start
    rows = seen.get["rows"]
    return df.sparkSession.createDataFrame(
        [(rows, seconds, rows / seconds)], "rows long, seconds double, rows_per_second double"
    )
