"""Corpus pipeline: quality filter, line dedup, near-dedup, decontamination, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from semesta.llm import bpe, decontaminate, lines, quality, simhash
from semesta.llm.common import scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return model.score(docs).filter(F.col("score") >= quality.THRESHOLD).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, repeated passages taken out; n_chars follows the text."""
    return lines.dedup(docs, pieces=lines.passages).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id."""
    return simhash.first_of_group(docs, shingle=3, reach=3).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids and the text that these decode to."""
    model = bpe.ByteBPE(
        bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN
    )
    encoded = model.encode(docs.select("doc_id", "lang", "source", "text"))
    return encoded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.decode(model.decode(F.col("ids")), "UTF-8").alias("decoded"),
    )


STAGES = [
    ("quality", quality_filter),
    ("lines", line_dedup),
    ("simhash", near_dedup),
    ("decontamination", decontamination),
    ("bpe", encode),
]

#: No stage of these can be expressed in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
