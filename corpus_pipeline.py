"""A corpus pipeline: quality, exact copies, near copies, benchmark leaks, tokens.

Each stage takes the documents its predecessor kept and returns them with the
columns of ``documents``; the last one returns the tokens. ``run`` writes each
stage's result as Parquet under the shared checkpoint folder and reads it back.

Rows that repeat a doc_id count as copies of one document once their texts are
equal (one stays); rows of one id with different texts are kept or dropped
together by the near-duplicate stage, which decides by id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm import bpe, decontaminate, exact_dedup, quality, simhash
from lakeward.llm.common import cut, prepare, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is among ``ids`` (one row for each id kept). A null
    doc_id matches a null."""
    wanted = ids.select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(wanted.hint("merge"), docs["doc_id"].eqNullSafe(wanted["_kept_id"]), "left_semi")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at 0.5 or more."""
    prepare(spark)
    model = quality.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(quality.score_column(F.col("text"), model) >= 0.5).select(*COLUMNS)


def exact_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepare(spark)
    verdicts = cut(exact_dedup.exact_duplicates(docs), "exact-verdicts")
    kept = keep_ids(docs, verdicts.where("kept")).select(*COLUMNS)
    if verdicts.groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    # Some id has several rows: among its equal texts one is left.
    bare = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]", "")
    one = kept.withColumn("_sha", F.sha2(bare, 256))
    stay = verdicts.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha2")).distinct()
    same = one["doc_id"].eqNullSafe(stay["_id"]) & (one["_sha"] == stay["_sha2"])
    return one.join(stay, same, "left_semi").dropDuplicates(["doc_id", "_sha"]).select(*COLUMNS)


def near_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each component of near copies."""
    prepare(spark)
    groups = simhash.near_duplicates(docs, width=3, distance=3)
    return keep_ids(docs, groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))).select(*COLUMNS)


def decontaminate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    prepare(spark)
    flagged = decontaminate.leaking(docs, table(spark, sf_dir, "benchmark"), "_leaks")
    return flagged.where(~F.col("_leaks")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, their number and digest, and that of the decoded text."""
    prepare(spark)
    encoded = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.with_digests(encoded, "ids")


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_filter),
    ("simhash", near_filter),
    ("decontamination", decontaminate_filter),
    ("bpe", encode),
]

#: A classifier, edit distances and merges are beyond SQL; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
