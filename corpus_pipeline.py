"""A corpus pipeline of five stages, each calling one operator of ``mercata.llm``.

Toxic documents go; one document of each group of near copies stays; secrets are masked in
place; sources are mixed to their target weights, so a document may leave or stay twice; what is
left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercata.llm import mixing, ngram_join, packing, secrets, toxicity
from mercata.llm.support import WRITTEN, prepare, release, stored, table

COPY_WORDS, COPY_SHARE = 5, 80  # near copies: runs of five words, 0.8 of the union; op1 has its own 4 and 0.85


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(prepare(spark), sf_dir, "labels"))
    return toxicity.score(docs, model, keep=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join.one_of_each(docs, COPY_WORDS, COPY_SHARE)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixture(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: The stages train a model and draw a sample by hash; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each over the written result of the one before.

    Once a stage's result is written, its intermediate tables and its input go.  Rows with null or empty texts are
    clean and pass every filter; they end as rows without a sequence where the mix takes them.  Rows without an id stay
    apart from each other; of rows with one id, and of near copies, one stays.  Texts of any length are worked
    on whole, no documents give no rows, and other columns pass through all stages but the last."""
    docs = table(prepare(spark), sf_dir, "documents")
    before = len(WRITTEN)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        release(spark, before, keep=1)
    return docs
