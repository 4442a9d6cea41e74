"""From raw documents to packed training sequences, stage by stage.

A stage begins by giving back what the stages before it have left: broadcasts, and the driver's garbage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fairlead.llm import decontaminate, jaccard, language, packing, secrets
from fairlead.llm.text import documents, release, shared_folder


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones teach."""
    release(spark)
    return language.accepted(docs, language.fitted(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, Jaccard 0.8 or more.

    SimHash fingerprints that pivot distance tables link, and MinHash bands, name the pairs to verify.
    """
    release(spark)
    return jaccard.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    release(spark)
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    release(spark)
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in training sequences."""
    release(spark)
    return packing.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]
#: Language models, fingerprints and token ids are beyond SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


#: Bytes of rows that a task hands to Python at once; executors keep several such buffers a task.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each keeps is written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    before = spark.conf.get(BATCH[0])
    spark.conf.set(*BATCH)
    try:
        for name, stage in STAGES:
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
            release(spark)
    finally:
        spark.conf.set(BATCH[0], before)
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
