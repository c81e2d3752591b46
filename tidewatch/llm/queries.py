"""Queries of the training-data operators: thin views over the operators with
production parameters, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.llm import (chat, codes, decontaminate, language, lm, neardup, packing, quality, repair, secrets,
                           sharding, toxicity, warc)
from tidewatch.llm.common import ship_package

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


HARD_TEXT = r"\### Assistant: </turn> ok"  # conversation -7: both of its texts


@register
def op1_chat_formatting(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit(HARD_TEXT).alias("text"))
    return chat.digests(chat.format_conversations(given.unionByName(hard)))


@register
def op2_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op3_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@register
def op4_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@register
def op5_secret_scan(spark, sf_dir):
    return secrets.report(table(spark, sf_dir, "documents"))


def fold(modulus: int) -> Column:
    """The fold of a document: crc32 of its id as text."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


@register
def op6_toxicity(spark, sf_dir):
    scored = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold(3) != 1)
    return scored.select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@register
def op7_language_id(spark, sf_dir):
    found = language.identify(table(spark, sf_dir, "documents"), fold(4) != 2)
    return found.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@register
def op8_quality_rules(spark, sf_dir):
    return quality.quality_rules(table(spark, sf_dir, "documents")).drop("longest_repeat")


@register
def op9_decontamination(spark, sf_dir):
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op10_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


@register
def op11_vector_codes(spark, sf_dir):
    return codes.compress(table(spark, sf_dir, "embeddings"))


@register
def op12_conversation_repair(spark, sf_dir):
    given = table(spark, sf_dir, "conversations")
    return repair.report(given, repair.repair(repair.damage(given)))


@register
def op13_lm_scoring(spark, sf_dir):
    scored = lm.score(table(spark, sf_dir, "documents"), fold(7) != 2)
    return scored.withColumn("held_out", F.coalesce(fold(7) == 2, F.lit(False))).drop("train")
