"""Corpus pipeline: documents to packed training sequences.

Each stage gets what the one before it has kept, as Parquet, and all but the last return the columns of documents:
toxic documents go; of equal texts one stays; of near copies one stays; the rest is put in the order of a mixture of
its sources; and that order is packed. Labels are read from sf_dir only to fit the toxicity model.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from sitecensus.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from sitecensus.llm.common import table, written
from sitecensus.llm.queries import vocabulary


#: Rows in a batch that goes to Python: whole texts, of which the usual 10,000 take hundreds of MB in two processes.
BATCH_ROWS = 2_000
#: Bytes after which such a batch ends: rows do not bound it, as a text may have 100 KB and a pair of near copies two of them.
BATCH_BYTES = 4 << 20
#: For the Python processes: what a large array has taken is given back when it is freed, instead of being kept for the next
#: stage, which runs in the same processes.
MALLOC = {"MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20), "ARROW_DEFAULT_MEMORY_POOL": "system"}


def bounded(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """stage, in a session whose batches for Python have BATCH_ROWS rows and end after BATCH_BYTES."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        name = "spark.sql.execution.arrow.maxRecordsPerBatch"
        spark.conf.set(name, min(BATCH_ROWS, int(spark.conf.get(name))))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        spark.sparkContext.environment.update(MALLOC)
        return stage(spark, docs, sf_dir)

    return run


@bounded
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


@bounded
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


@bounded
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_copies(docs)


@bounded
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.interleave(docs, mixing.target_weights(docs))


@bounded
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's order is that of the files which the stage before has written, and of the rows in them."""
    return packing.pack_documents(mixing.in_file_order(docs), vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The model of the first stage and the packing of the last are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: one for each piece of a packed document."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
