"""A training corpus from raw documents: five stages, each written and read again before the next.

``run`` applies the stages to ``documents`` and returns packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelode.llm import mixing, packing, simhash, suffixes, toxicity
from sitelode.llm.sampling import fold
from sitelode.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labels of documents outside one fold of five."""
    learned = F.coalesce(fold(F.col("doc_id"), 5) != 0, F.lit(False))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(learned)
    model = toxicity.fit(docs, labels)
    return docs.where(toxicity.score(F.col("text"), model) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: fingerprints of three-word shingles that differ in two bits at most."""
    return simhash.keep_one(docs, words=3, radius=2)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of fifty words or more stay in their earliest place only."""
    return suffixes.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the weights 5, 2 and 1 by turns, to half as many words again, none more than twice."""
    # Longer blocks than the default cut fewer documents.
    mixed = mixing.mixed_documents(docs, settings=mixing.Settings(block=256))
    return mixed.withColumn("n_chars", F.char_length("text").cast("bigint"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into sequences of 4096; ``row`` tells parts of one document apart."""
    import public_tokenizers

    cut = packing.pieces(F.col("text"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.inline(cut))
    return packing.pack(rows, 4096, order=["doc_id", "row", "piece", "start", "ids_crc32"])


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Learned scores, near copies and drawn blocks have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        place = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
