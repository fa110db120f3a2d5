"""What the operators share: written intermediate tables, numbering, batches of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.session import drop_path, scratch_path

ARROW_ROWS = 1_000        # rows of text handed to Python at once
BROADCAST_IDS = 4_000_000  # ids (32 MB) that are broadcast to pick rows; more are joined by a shuffle


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that long texts don't fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


WRITTEN: list[str] = []  # folders of the tables that ``stored`` wrote in this application, oldest first


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here, a lost
    executor costs no recomputation, and Spark knows the table's size."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, since: int, keep: int = 0) -> None:
    """Delete the tables stored after the first ``since``, but for the last ``keep``, once nothing reads them."""
    for path in WRITTEN[since:len(WRITTEN) - keep]:
        drop_path(spark, path)
    del WRITTEN[since:len(WRITTEN) - keep]


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``stored`` made and that nothing reads any more."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        drop_path(df.sparkSession, folder)


def picked(rows: DataFrame, ids: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """Rows whose ``on`` is among (``left_anti``: not among) a written table of ids.  The ids are broadcast if
    their number, which is checked, allows; so the rows, with their texts, mostly stay where they are."""
    ids = ids.select(ids.columns[0]).toDF("picked_id")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return rows.alias("r").join(ids.alias("i"), F.col(f"r.{on}") == F.col("i.picked_id"), how)


def blocks_of(rows: int, per_block: int) -> int:
    """How many blocks of about ``per_block`` rows hold ``rows`` rows."""
    return max(1, -(-rows // per_block))


def hashed_block(blocks: int, *columns) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int")


def uniform(seed: int, *columns) -> Column:
    """A number strictly between 0 and 1 that depends on the columns alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12)
    return (bits.cast("double") + F.lit(0.5)) * F.lit(2.0**-52)
