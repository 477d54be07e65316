"""From raw documents to packed training sequences: five stages, each one operator of ``ledgerlight.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its output is written as Parquet and read again as
the next one's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm.lines import line_dedup
from ledgerlight.llm.mixing import drawn, mix
from ledgerlight.llm.packing import pack
from ledgerlight.llm.quality import quality_rules
from ledgerlight.llm.shared import WORD_PATTERN, few, free_name, scratch_scope, stored
from ledgerlight.llm.similarity import near_duplicates


def _stage(work):
    """A stage whose scratch tables go when the next one begins; by then its result is written."""
    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with scratch_scope(spark, "pipeline"):
            return work(spark, docs, sf_dir)
    return run_stage


#: Near duplicates: shingles of five words, 80 % or more in common.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts go, as too short."""
    return quality_rules(docs, carry=True).where("kept").select("row.*")


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeated runs of lines; those left without a word go. ``n_chars`` follows the text."""
    cut = line_dedup(docs)
    found = cut.where((F.col(cut.columns[-1]) == 0) | F.regexp_like("text", F.lit(WORD_PATTERN)))
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@_stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest ``doc_id``. Rows without an id stay. Different rows
    under one id are documents of their own, which come after all others; rows that are equal in every column are one."""
    key, more, same = (free_name(docs, n) for n in ("_key", "_more", "_same"))
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    again = few(stored(ids.where("n > 1").select(F.col("doc_id").alias(same)), "again"))
    # repeated ids get keys by their rows' content, beyond the usual numbers
    own = F.lit(1 << 62) + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(1 << 62))
    keyed = docs.join(again, F.col("doc_id") == F.col(same), "left")
    keyed = keyed.select(*docs.columns, F.when(F.col(same).isNull(), F.col("doc_id")).otherwise(own).alias(key), F.col(same).isNotNull().alias(more))
    found = near_duplicates(keyed, key=key, words=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    gone = few(stored(found.where("key <> component").select(F.col("key").alias(key)).distinct(), "near"))
    stay = keyed.join(gone, key, "left_anti")
    return stay.where(~F.col(more)).union(stay.where(more).dropDuplicates([key])).select(*docs.columns)


@_stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the sources' target weights, shuffled; a document may be drawn twice."""
    return drawn(docs, mix(docs)).select(*docs.columns)


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece of a document."""
    return pack(docs).withColumnRenamed("key", "doc_id").withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near), ("mixing", mixture), ("packing", packed)]

#: Tokenisers and medians over measured texts are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = stored(docs, f"stage-{n + 1}")
    return docs
