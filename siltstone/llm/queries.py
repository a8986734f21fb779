"""The operators as queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import (
    alignment, archive, decontamination, language, language_model, near_dup, packing, phrases, pii, repeats, secrets, sharding, vectors,
)
from siltstone.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_content_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "archive")
    archive.write_archive(table(spark, sf_dir, "pages"), path)
    records = archive.reread(archive.record_bytes(archive.read_archive(spark, path)))
    return archive.parsed(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE["op2_content_archive"] = r"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS owner FROM pages
), d AS (
    SELECT *, sha1(body) AS hex FROM p
)
SELECT page_id,
       strlen(body)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
           (('0x' || substr(hex, 1 + 10 * (i // 8)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id < owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < owner THEN owner END AS refers_to
FROM d
"""


@query
def op3_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op3_containment"] = decontamination.ORACLE_SQL


@query
def op4_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), scratch_dir(spark, "slot-map"))
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


@query
def op8_spherical_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query
def op9_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


@query
def op1_family_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.redact(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.surrogate_key(spark))


@query
def op7_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"))


@query
def op10_merged_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


@query
def op11_incidence_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


@query
def op12_dynamic_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLE["op12_dynamic_phrases"] = phrases.ORACLE_SQL


@query
def op13_layered_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))
