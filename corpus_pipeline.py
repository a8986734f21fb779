"""From raw documents to packed training sequences: five stages, each one of the operators in ``siltstone.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import decontamination, language, near_dup, packing, pii
from siltstone.llm.common import if_small, store


SIMILARITY = 80
KEY = "_key"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without text or without a letter go.

    Families and machines are learned from the labelled documents among ``docs``;
    without any, every document goes.  Repeated rows and rows with a null id are
    judged each; no document gives no document.
    """
    model = language.learn(docs.select("doc_id", "text", "lang"))
    return language.predicted(docs, model, *docs.columns).where(F.col("lang_pred") != language.UNKNOWN).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of similarity 0.8 or more; of rows with equal ids and texts, one.

    A document without an id stays only where no document of its group has one,
    and then one of them.  Null and empty texts have no group and stay.
    """
    docs = _with_ids(docs)
    found = near_dup.near_duplicates(docs.withColumn("doc_id", F.col(KEY)), threshold=SIMILARITY).where("NOT kept")
    gone = store(found.select(F.col("doc_id").alias("gone")).distinct(), "near-duplicates")
    kept = docs.join(if_small(gone), docs[KEY] == F.col("gone"), "left_anti")
    again = store(kept.groupBy(KEY).count().where("count > 1").select(F.col(KEY).alias("again")), "repeated-ids")
    if not again.count():
        return kept.drop(KEY)
    # Only rows whose id occurs again are compared as whole rows.
    same = kept[KEY] == F.col("again")
    twice = kept.join(if_small(again), same, "left_semi").dropDuplicates([KEY, "text"])
    return kept.join(if_small(again), same, "left_anti").unionByName(twice).drop(KEY)


def _with_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with a key: the id, or where it is null a number of its own above all ids."""
    last, missing = docs.agg(F.max("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    if not missing:
        return docs.withColumn(KEY, F.col("doc_id"))
    number = F.lit(0 if last is None else last + 1) + F.monotonically_increasing_id()
    # Stored, so that the numbers are the same wherever they are used.
    return store(docs.withColumn(KEY, F.coalesce("doc_id", number)), "keys")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.  Null and empty texts contain none; repeated rows are judged each."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced.  Null and empty texts and repeated rows stay as they are.

    The secret is the session's (``siltstone.surrogate.key``), or one of this run alone.
    """
    redacted = pii.redact(docs, pii.surrogate_key(spark))
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return redacted.select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences.  A null or empty text is its end alone; repeated rows are packed each."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("surrogates", surrogates),
    ("packed_sequences", packed_sequences),
]

#: Signatures, keyed surrogates and tokenizers have no SQL; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what a stage returns is stored and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
