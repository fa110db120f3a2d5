"""Load review files as they arrive, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.sources.readers import parse_reviews
from mercata.sources.tables import append_reviews
from mercata.streaming import summaries


def refresh_reviews(
    spark: SparkSession, folder: str, path: str, checkpoint: str, bad_records: str = "fail",
    files_per_batch: int = 1000, summary_folder: str | None = None, products: DataFrame | None = None,
) -> None:
    """Append all files not seen before to the reviews table, then stop.

    The checkpoint remembers the files.  A batch is written under its number and
    replaces itself when it is run again, so a failure neither loses nor repeats rows.  With a
    ``summary_folder`` the summaries of the categories it touches are renewed there (:mod:`mercata.streaming.summaries`).
    """
    lines = (
        spark.readStream.schema("value string")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(folder)
        .withColumn("source_category", F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1))
        .where(F.trim("value") != "")
    )

    def load(batch: DataFrame, number: int) -> None:
        reviews = parse_reviews(batch, bad_records)
        append_reviews(reviews, path, f"batch-{number}")
        if summary_folder is not None:
            summaries.add_load(reviews, summary_folder, f"batch-{number}", products)

    query = (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
