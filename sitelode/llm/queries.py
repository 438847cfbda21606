"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, conversations, language, licenses, lm, manifest, mixing, packing, repetition, sharding, simhash, suffixes, toxicity
from .oracle import ORACLE
from .sampling import fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces, packed into sequences of 4096 tokens."""
    import public_tokenizers

    cut = packing.pieces(F.col("text"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.inline(cut))
    return packing.pack(rows, 4096, order=["doc_id", "piece", "start", "ids_crc32"])


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes of every document."""
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixing.taken_words(mixed).withColumnRenamed("_id", "doc_id")


def op3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules by repetition coverage, of every document."""
    judged = _table(spark, sf_dir, "documents").select("doc_id", repetition.repetition(F.col("text")).alias("r"))
    return judged.select("doc_id", "r.*")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equal numbers of rows, uniformly shuffled."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    narrow = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32")
    )
    dealt = sharding.shuffle_to_shards(narrow, 40)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth vector."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    documents = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    model = language.fit(documents.where(~held_out), "text", "lang")
    predicted = language.predict(F.col("text"), model)
    return documents.select("doc_id", held_out.alias("held_out"), predicted.alias("p")).select("doc_id", "held_out", "p.*")


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of fifty words or more that documents repeat, with the place they repeat."""
    return suffixes.repeated_passages(_table(spark, sf_dir, "documents")).drop("_doc")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies by SimHash: fingerprint and component of every document."""
    groups = simhash.near_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document; a sixth of the training documents is where weights are learned."""
    remainder = F.coalesce(fold(F.col("doc_id"), 7), F.lit(0))
    role = F.when(remainder == 2, lm.HELD_OUT).when(remainder == 3, lm.DELETED).otherwise(lm.COUNTED)
    return lm.score(_table(spark, sf_dir, "documents"), "doc_id", "text", role)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of four fifths of them."""
    documents = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out)
    model = toxicity.fit(documents, labels)
    scored = documents.select("doc_id", held_out.alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents by source, with each row's proof tried on a tampered text."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    documents = _table(spark, sf_dir, "documents")
    stripped = [F.replace("text", F.lit("\n"), F.lit("")) if f == "text" else F.col(f) for f in fields]
    tampered = F.when(fold(F.col("doc_id"), 2) == 0, manifest.digest(manifest.record(*stripped)))
    proven = manifest.manifest(documents, "doc_id", "source", fields, {"tampered": tampered})
    told = proven.select(
        "doc_id", "source", "leaf", "subroot", "root", manifest.proof_digest(F.col("proof")).alias("proof_sha256"),
        manifest.folded(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"),
    )
    return told.withColumn("verified", F.col("folded_root") == F.col("root")).drop("source")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations: what is wrong with each, the cheapest repair and a digest of the repaired rows."""
    given = _table(spark, sf_dir, "conversations")
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    repaired = conversations.repair(conversations.damaged(given, conv, F.concat(named[0], F.lit(":"), named[1])))
    every = given.select("conv_id", conv.alias("conv")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    told = every.join(repaired.summary, "conv", "left").join(conversations.line_digests(repaired.lines), "conv", "left")
    return told.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document: phrases, and templates that some block of the text meets."""
    return licenses.license_scan(_table(spark, sf_dir, "documents"), "text", ["doc_id"])


QUERIES = {
    "op1_packing": op1_packing,
    "op9_lm": op9_lm,
    "op10_toxicity": op10_toxicity,
    "op2_mixing": op2_mixing,
    "op3_repetition": op3_repetition,
    "op4_sharding": op4_sharding,
    "op5_neighbours": op5_neighbours,
    "op6_language": op6_language,
    "op7_suffixes": op7_suffixes,
    "op8_simhash": op8_simhash,
    "op11_manifest": op11_manifest,
    "op12_conversations": op12_conversations,
    "op13_licenses": op13_licenses,
}

