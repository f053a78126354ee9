"""The corpus pipeline: quality, near duplicates, benchmark passages, secrets, and the mix of sources.

Every stage works on all that the stage before kept, and is written out and read again, so a lost executor costs at most
one stage. All but the last return the columns of ``documents``; the last returns the documents of the mix, each as often
as it is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, mixing, near_dedup, quality_rank, secrets
from ledgerlens.llm.common import bounded_batches, fresh, read
from ledgerlens.llm.queries import NEAR, learned_ranking
from ledgerlens.session import staged


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking accepts. A missing text is judged as an empty one. Features are computed once, and stored."""
    bounded_batches(spark)
    features = fresh(docs, "_features")
    measured = staged(docs.withColumn(features, quality_rank.features("text")), "measured")
    ranking = learned_ranking(measured.select("doc_id", F.col(features).alias("x")), read(spark, sf_dir, "labels"))
    return measured.filter(quality_rank.score(F.col(features), ranking) >= ranking.cut).select(*docs.columns)


def keep_first_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id; of repeated rows, one."""
    bounded_batches(spark)
    kept = near_dedup.grouped(docs, NEAR).filter("kept").select("key").distinct()
    key = fresh(docs, "_key")
    keyed = docs.withColumn(key, near_dedup.row_key("doc_id", "text"))
    return keyed.join(kept.withColumnRenamed("key", key), key).dropDuplicates([key]).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage of weight."""
    bounded_batches(spark)
    return decontaminate.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without keys, passwords or random strings; known digests are none."""
    bounded_batches(spark)
    return secrets.without_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix."""
    return mixing.mixed(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_first_of_near),
    ("decontamination", drop_contaminated),
    ("secrets", drop_secrets),
    ("mixing", mix_sources),
]

#: The learned score, the connected groups and the tokenizer are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
